"""Cleaning, gates and instruction detection on a streaming DataFrame.

The row-level expressions keep no state, so a stream needs neither watermark nor
state store; a checkpoint folder of the query makes its output exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..config import CleaningConfig
from ..functions.instructions import instruction
from ..functions.text import named
from ..plans.processing import clean_texts


def clean_stream(stream: DataFrame, text_col: str, config: CleaningConfig = CleaningConfig(),
                 gazetteer=None) -> DataFrame:
    """Accepted rows with cleaned text and ``<text_col>_instruction``."""
    accepted = clean_texts(stream, text_col, config, gazetteer)
    return accepted.withColumn(f"{text_col}_instruction", instruction(named(text_col)))


def write_available(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write what is there as parquet and stop."""
    return (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
