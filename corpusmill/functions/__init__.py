"""Row-level expressions: Column in, Column out, no shuffle, batch or stream."""
