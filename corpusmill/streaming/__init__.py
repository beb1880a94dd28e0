"""The row-level operators on a stream."""
