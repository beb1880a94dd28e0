"""What several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import named
from ..session import scratch_path, small_batches  # noqa: F401 - the operators take it from here

# The six ASCII white-space characters: blank, tab, line feed, vertical tab, form feed, return.
ASCII_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, _UPPER, _UPPER.lower())


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write below the shared folder and read back: lineage ends here, so a lost executor
    costs a re-read, and plans above see a plain scan."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def keyed_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, text): only what an operator reads, so that other columns cannot clash.
    A null text is empty."""
    return docs.select(named(key).alias("doc"), F.coalesce(named(text).cast("string"), F.lit("")).alias("text"))
