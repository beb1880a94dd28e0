"""Approximate distinct counts by sketches that are kept and united.

A HyperLogLog sketch per group and column is a few kilobytes, whatever the group's size. Sketches of
files or days are a table: a new day adds its rows, and any union of days is counted without reading the
texts again. Copies in several groups are counted once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import named

# 2 ** LG_K registers of four bits.
LG_K = 12
# Three standard errors of an estimate: a wider gap has a chance of 3 in 1,000.
ERROR = 3 * 1.04 / 2 ** (LG_K / 2)


def text_sketches(df: DataFrame, by: tuple[str, ...] = (), lg_k: int = LG_K) -> DataFrame:
    """(by..., column, n_rows, n_values, sketch) for each string column and group.

    Null values are in no sketch. Each task hands over one sketch per group and column.
    """
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in by]
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(columns):
        aggregates += [F.count(named(c)).alias(f"n_{i}"), F.hll_sketch_agg(named(c), F.lit(lg_k)).alias(f"s_{i}")]
    keys = [named(b) for b in by]
    entries = [
        F.struct(F.lit(c).alias("column"), "n_rows", F.col(f"n_{i}").alias("n_values"), F.col(f"s_{i}").alias("sketch"))
        for i, c in enumerate(columns)
    ]
    none = F.array().cast("array<struct<column:string,n_rows:bigint,n_values:bigint,sketch:binary>>")
    return df.groupBy(*keys).agg(*aggregates).select(*keys, F.inline(F.array(*entries) if entries else none))


def united(sketches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., column, n_rows, n_values, sketch): the sketches of several groups as one; may be united again."""
    return sketches.groupBy(*[named(b) for b in by], "column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.hll_union_agg("sketch", F.lit(True)).alias("sketch"),
    )


def estimated_uniqueness(sketches: DataFrame) -> DataFrame:
    """The table with ``distinct_values``, about how many there are, in place of the sketches, and the share
    of the rows that they are, ``uniqueness``."""
    distinct = F.least(F.hll_sketch_estimate("sketch"), F.col("n_values"))
    return sketches.withColumns(
        {"distinct_values": distinct, "uniqueness": F.coalesce(F.try_divide(distinct, F.col("n_rows")), F.lit(0.0))}
    ).drop("sketch")
