"""Referential integrity: do the values of a column exist in their parent table?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import named
from ..session import written
from .bloom import BloomFilter, can_filter


def reference_columns(fields: list[T.StructField]) -> list[str]:
    return [f.name for f in fields if f.name.endswith(("_id", "_ref"))]


def _checked(
    df: DataFrame, column: str, parent: DataFrame, parent_column: str, by=(), filtered: bool = False
) -> DataFrame:
    """(by..., value, n, found): distinct values, how often each occurs, whether it exists.

    Counting first leaves one row per value, so a value that fills the table is as
    cheap to join as any other. ``filtered`` builds a Bloom filter of the parent's values first: a
    value that it rules out is an orphan at once, and is neither joined nor, with its copies,
    shuffled to be. It pays where the child has far more values than the parent holds.
    """
    keys = [named(b) for b in by]
    counted = (
        df.where(named(column).isNotNull())
        .groupBy(*keys, named(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = (
        parent.where(named(parent_column).isNotNull())
        .select(named(parent_column).alias("_known"))
        .distinct()
    )
    def looked_up(rows: DataFrame) -> DataFrame:
        return rows.join(known, F.col("value") == F.col("_known"), "left").select(
            *keys, "value", "n", F.col("_known").isNotNull().alias("found")
        )

    if not filtered or not can_filter(df.schema[column].dataType, parent.schema[parent_column].dataType):
        return looked_up(counted)
    test = BloomFilter.of(parent.select(named(parent_column).alias("key")), "key").might_hold(F.col("value"))
    tested = written(counted.withColumn("_might", test), "tested-values")
    ruled_out = tested.where(~F.col("_might")).select(*keys, "value", "n", F.lit(False).alias("found"))
    return looked_up(tested.where("_might").drop("_might")).union(ruled_out)


def found_shares(df: DataFrame, references: dict, by=(), filtered: bool = False) -> dict[str, DataFrame]:
    """Per referencing column a frame with the share of its values that exist."""
    keys = [named(b) for b in by]
    return {
        column: _checked(df, column, parent, parent_column, by, filtered)
        .groupBy(*keys)
        .agg(
            F.try_divide(
                F.sum(F.when(F.col("found"), F.col("n")).otherwise(0)), F.sum("n")
            ).alias(f"found_{column}")
        )
        for column, (parent, parent_column) in references.items()
        if column in df.columns
    }


def integrity(df: DataFrame, references: dict | None = None, filtered: bool = False) -> DataFrame:
    """(column, found_share) of every referencing column; unregistered ones count as 1.

    ``filtered`` rules most orphans out by a Bloom filter of each parent, for huge children.
    """
    references = references or {}
    frames = list(found_shares(df, references, filtered=filtered).items())
    rest = [c for c in reference_columns(df.schema.fields) if c not in references]
    result = None
    for column, share in frames:
        row = share.select(
            F.lit(column).alias("column"),
            F.coalesce(F.col(f"found_{column}"), F.lit(1.0)).alias("found_share"),
        )
        result = row if result is None else result.unionByName(row)
    if rest:
        rows = df.sparkSession.createDataFrame(
            [(c, 1.0) for c in rest], "column string, found_share double"
        )
        result = rows if result is None else result.unionByName(rows)
    if result is None:
        result = df.sparkSession.createDataFrame([], "column string, found_share double")
    return result


def orphans(
    df: DataFrame, column: str, parent: DataFrame, parent_column: str, filtered: bool = False
) -> DataFrame:
    """(value, n) of the values without a parent."""
    return _checked(df, column, parent, parent_column, filtered=filtered).where(~F.col("found")).select("value", "n")
