"""The batch gate: four scores, and all rows or none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import named
from .distinct import ROWS, distinct_alias, distinct_counts
from .profile import is_missing, stack


def length_evenness(mean: Column, sd: Column) -> Column:
    """1 - sd / mean, not clamped; null for a single value, 0 where nothing has length."""
    return F.when(mean > 0, 1.0 - F.try_divide(sd, mean)).otherwise(F.lit(0.0))


def _strict_mean(scores: list[Column], default: float) -> Column:
    """A mean that is null as soon as one score is."""
    if not scores:
        return F.lit(default)
    total = scores[0]
    for s in scores[1:]:
        total = total + s
    return total / F.lit(float(len(scores)))


def gate_scores(df: DataFrame) -> DataFrame:
    """One row: completeness, consistency, validity, uniqueness, overall.

    All are null for an empty frame, but consistency, which is that of no length.
    """
    fields = df.schema.fields
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    consistency, shares = [], []
    cells = F.lit(0)
    for i, f in enumerate(fields):
        aggregates.append(F.count_if(~is_missing(f)).alias(f"present_{i}"))
        cells = cells + F.col(f"present_{i}")
        shares.append(F.try_divide(F.col(f"present_{i}"), F.col("n_rows")))
        if isinstance(f.dataType, T.StringType):
            length = F.length(named(f.name))
            aggregates += [
                F.avg(length).alias(f"mean_{i}"), F.stddev_samp(length).alias(f"sd_{i}")
            ]
            consistency.append(length_evenness(F.col(f"mean_{i}"), F.col(f"sd_{i}")))
    stacked = stack([df.agg(*aggregates), distinct_counts(df, {ROWS: fields})])
    total = F.col("n_rows") * F.lit(len(fields))
    return stacked.select(
        (1.0 - F.try_divide(total - cells, total)).alias("completeness"),
        _strict_mean(consistency, 1.0).alias("consistency"),
        _strict_mean(shares, 0.0).alias("validity"),
        F.try_divide(F.col(distinct_alias(ROWS)), F.col("n_rows")).alias("uniqueness"),
    ).select(
        "*",
        _strict_mean(
            [F.col(c) for c in ("completeness", "consistency", "validity", "uniqueness")], 0.0
        ).alias("overall"),
    )


def batch_gate(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    """All rows of ``df`` when its overall score reaches ``threshold``, else none.

    The score enters as a scalar subquery, so the rows are only filtered.
    """
    overall = gate_scores(df).select("overall").scalar()
    return df.where(F.coalesce(overall >= threshold, F.lit(False)))
