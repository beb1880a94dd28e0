"""The quality profile: seven dimensions, an overall score and a verdict.

Each dimension is a set of aggregates and an expression over them, so that one
dimension alone and the whole profile share their code. The profile runs
1. one fused aggregation for everything a single pass can give,
2. one distinct count over digests (see ``distinct``),
3. for numeric columns, a pass that needs their mean and deviation.
Each yields one row per group; they are stacked and folded by group.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DIMENSION_WEIGHTS, QUALITY_DIMENSIONS, QualityConfig
from ..functions.scoring import text_quality
from ..functions.text import named, parse_time, two_decimals
from .distinct import ROWS, approximate_distinct_aggregates, distinct_alias, distinct_counts
from .integrity import found_shares, reference_columns

# Rows of one group are spread over this many keys when group statistics are joined.
SALTS = 64


@dataclass
class Parts:
    """Aggregates of a pass over the data, and the score they make."""

    score: Column
    aggregates: list[Column] = field(default_factory=list)


def columns_of(df: DataFrame, by=()) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name not in by]


def is_missing(f: T.StructField) -> Column:
    """Null, or NaN where the type has it."""
    missing = named(f.name).isNull()
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        missing = missing | F.isnan(named(f.name))
    return missing


def mean_of(scores: list[Column], default: float) -> Column:
    """Mean of the non-null scores, ``default`` when there is none."""
    if not scores:
        return F.lit(default)
    total, count = F.lit(0.0), F.lit(0)
    for s in scores:
        total = total + F.coalesce(s, F.lit(0.0))
        count = count + s.isNotNull().cast("int")
    return F.coalesce(F.try_divide(total, count), F.lit(default))


def _unless_empty(score: Column, empty: float = 0.0) -> Column:
    return F.when(F.col("n_rows") > 0, score).otherwise(F.lit(empty))


def _n_rows() -> Column:
    return F.count(F.lit(1)).alias("n_rows")


def _present(i: int, f: T.StructField) -> Column:
    return F.count_if(~is_missing(f)).alias(f"present_{i}")


def completeness_parts(fields: list[T.StructField]) -> Parts:
    present = F.lit(0)
    for i, _ in enumerate(fields):
        present = present + F.col(f"present_{i}")
    cells = F.col("n_rows") * F.lit(max(len(fields), 1))
    return Parts(
        _unless_empty(F.lit(1.0) - F.try_divide(cells - present, cells)),
        [_n_rows(), *[_present(i, f) for i, f in enumerate(fields)]],
    )


def consistency_parts(fields: list[T.StructField]) -> Parts:
    aggregates, scores = [_n_rows()], []
    for i, f in enumerate(fields):
        if not isinstance(f.dataType, T.StringType):
            continue
        length = F.length(named(f.name))
        aggregates += [
            F.avg(length).alias(f"len_mean_{i}"),
            F.stddev_samp(length).alias(f"len_sd_{i}"),
        ]
        mean, sd = F.col(f"len_mean_{i}"), F.col(f"len_sd_{i}")
        even = F.coalesce(F.greatest(F.lit(0.0), 1.0 - F.try_divide(sd, mean)), F.lit(0.0))
        # The deviation of a single value is unknown, which counts as 0.
        scores.append(F.when(mean > 0, F.when(sd.isNull(), 0.0).otherwise(even)))
    return Parts(_unless_empty(mean_of(scores, 1.0)), aggregates)


def validity_parts(fields: list[T.StructField], config: QualityConfig) -> Parts:
    aggregates, shares = [_n_rows()], []
    for i, f in enumerate(fields):
        if isinstance(f.dataType, T.StringType) and config.text_length_threshold > 0:
            aggregates.append(
                F.count_if(F.length(named(f.name)) >= config.text_length_threshold).alias(
                    f"valid_{i}"
                )
            )
            valid = F.col(f"valid_{i}")
        else:
            aggregates.append(_present(i, f))
            valid = F.col(f"present_{i}")
        shares.append(F.try_divide(valid, F.col("n_rows")))
    return Parts(_unless_empty(mean_of(shares, 0.0)), aggregates)


def distinct_slots(fields: list[T.StructField]) -> dict[int, list[T.StructField]]:
    slots = {ROWS: fields}
    for i, f in enumerate(fields):
        if isinstance(f.dataType, T.StringType):
            slots[i] = [f]
    return slots


def row_uniqueness_score() -> Column:
    return _unless_empty(F.try_divide(F.col(distinct_alias(ROWS)), F.col("n_rows")))


def text_uniqueness_score(fields: list[T.StructField]) -> Column:
    shares = [
        F.try_divide(F.col(distinct_alias(i)), F.col("n_rows"))
        for i, f in enumerate(fields)
        if isinstance(f.dataType, T.StringType)
    ]
    return _unless_empty(mean_of(shares, 1.0))


def uniqueness_score(fields: list[T.StructField]) -> Column:
    return 0.7 * row_uniqueness_score() + 0.3 * text_uniqueness_score(fields)


def timeliness_parts(f: T.StructField | None, as_of, config: QualityConfig) -> Parts:
    """Mean freshness at ``as_of`` (default: now); values that are no time are skipped."""
    if f is None:
        return Parts(F.lit(1.0), [_n_rows()])
    when = named(f.name)
    if isinstance(f.dataType, T.StringType):
        when = parse_time(when)
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    age_days = (F.unix_micros(now) - F.unix_micros(when.cast("timestamp"))) / F.lit(86_400_000_000)
    aged = F.least(F.greatest(age_days / config.max_data_age_days, F.lit(0.0)), F.lit(1.0))
    # least and greatest pass over nulls; a value that is no time has no freshness.
    fresh = F.when(age_days.isNotNull(), 1.0 - aged)
    return Parts(
        F.coalesce(F.col("freshness"), F.lit(1.0)),
        [_n_rows(), F.avg(fresh).alias("freshness")],
    )


def unreadable_times(df: DataFrame, timestamp_column: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., n_filled, n_unreadable): how many values there are, and how many of them are no time, which
    timeliness passes over."""
    value = named(timestamp_column)
    text = isinstance(df.schema[timestamp_column].dataType, T.StringType)
    unreadable = value.isNotNull() & (parse_time(value).isNull() if text else F.lit(False))
    return df.groupBy(*[named(b) for b in by]).agg(
        F.count(value).alias("n_filled"), F.count_if(unreadable).alias("n_unreadable")
    )


def text_accuracy_parts(fields: list[T.StructField], config: QualityConfig) -> tuple[list, list]:
    aggregates, scores = [], []
    for i, f in enumerate(fields):
        if isinstance(f.dataType, T.StringType):
            aggregates.append(F.avg(text_quality(named(f.name), config)).alias(f"quality_{i}"))
            scores.append(F.coalesce(F.col(f"quality_{i}"), F.lit(0.0)))
    return aggregates, scores


def _number(f: T.StructField) -> Column:
    return F.when(~is_missing(f), named(f.name).cast("double"))


def outlier_frame(df: DataFrame, by=()) -> DataFrame | None:
    """Per group and numeric column the share of values beyond 3 deviations: ``out_<i>``.

    Without groups the moments enter as a scalar subquery. With groups they are
    joined, and since one group may hold most rows, the rows of a group are spread
    over salted copies of its moments.
    """
    fields = columns_of(df, by)
    numeric = [(i, f) for i, f in enumerate(fields) if isinstance(f.dataType, T.NumericType)]
    if not numeric:
        return None
    keys = [named(b) for b in by]
    moments = df.groupBy(*keys).agg(
        F.struct(
            *[F.avg(_number(f)).alias(f"m{i}") for i, f in numeric],
            *[F.stddev_pop(_number(f)).alias(f"s{i}") for i, f in numeric],
        ).alias("_moments")
    )
    values = df.select(*keys, *[_number(f).alias(f"x{i}") for i, f in numeric])
    if not by:
        stats = moments.select("_moments").scalar()
        rows = values

        def moment(name: str) -> Column:
            return stats.getField(name)
    else:
        # Narrow hash of the values themselves: any spread does.
        salt = F.pmod(F.xxhash64(*[F.col(f"x{i}") for i, _ in numeric]), F.lit(SALTS)).cast("int")
        copies = moments.select(
            *[named(b).alias(f"_by{k}") for k, b in enumerate(by)],
            "_moments",
            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
        )
        match = F.col("_salt") == F.col("_salt_of")
        for k, b in enumerate(by):
            match = match & named(b).eqNullSafe(F.col(f"_by{k}"))
        rows = values.withColumn("_salt_of", salt).join(copies, match)

        def moment(name: str) -> Column:
            return F.col("_moments").getField(name)

    shares = []
    for i, _ in numeric:
        distance = F.abs(F.col(f"x{i}") - moment(f"m{i}"))
        beyond = (moment(f"s{i}") > 0) & (F.try_divide(distance, moment(f"s{i}")) > 3)
        shares.append(
            F.avg(
                F.when(F.col(f"x{i}").isNotNull(), F.coalesce(beyond, F.lit(False)).cast("double"))
            ).alias(f"out_{i}")
        )
    return rows.groupBy(*keys).agg(*shares)


def outlier_scores(fields: list[T.StructField]) -> list[Column]:
    return [
        1.0 - F.col(f"out_{i}")
        for i, f in enumerate(fields)
        if isinstance(f.dataType, T.NumericType)
    ]


def _unique_aliases(aggregates: list[Column]) -> list[Column]:
    """Aggregates that several dimensions share, once."""
    seen = {}
    for a in aggregates:
        seen.setdefault(str(a), a)
    return list(seen.values())


def stack(frames: list[DataFrame], by=()) -> DataFrame:
    """Fold frames of one row per group into one: union, then one non-null per column."""
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f, allowMissingColumns=True)
    return union.groupBy(*[named(b) for b in by]).agg(
        *[F.max(named(c)).alias(c) for c in union.columns if c not in by]
    )


def _single(df: DataFrame, parts: Parts, name: str, by=()) -> DataFrame:
    keys = [named(b) for b in by]
    return df.groupBy(*keys).agg(*_unique_aliases(parts.aggregates)).select(
        *keys, parts.score.alias(name)
    )


def _no_columns(df: DataFrame) -> bool:
    return not df.columns


def _constant(df: DataFrame, name: str, value: float) -> DataFrame:
    return df.sparkSession.range(1).select(F.lit(value).alias(name))


def completeness(df: DataFrame, by=()) -> DataFrame:
    if _no_columns(df):
        return _constant(df, "completeness", 0.0)
    return _single(df, completeness_parts(columns_of(df, by)), "completeness", by)


def consistency(df: DataFrame, by=()) -> DataFrame:
    if _no_columns(df):
        return _constant(df, "consistency", 0.0)
    return _single(df, consistency_parts(columns_of(df, by)), "consistency", by)


def validity(df: DataFrame, config: QualityConfig = QualityConfig(), by=()) -> DataFrame:
    if _no_columns(df):
        return _constant(df, "validity", 0.0)
    return _single(df, validity_parts(columns_of(df, by), config), "validity", by)


def uniqueness(df: DataFrame, by=()) -> DataFrame:
    """Row, text and combined uniqueness."""
    fields = columns_of(df, by)
    keys = [named(b) for b in by]
    if not fields:
        return df.sparkSession.range(1).select(
            *[F.lit(0.0).alias(n) for n in ("row_uniqueness", "text_uniqueness", "uniqueness")]
        )
    stacked = stack(
        [df.groupBy(*keys).agg(_n_rows()), distinct_counts(df, distinct_slots(fields), tuple(by))],
        by,
    )
    return stacked.select(
        *keys,
        row_uniqueness_score().alias("row_uniqueness"),
        text_uniqueness_score(fields).alias("text_uniqueness"),
        uniqueness_score(fields).alias("uniqueness"),
    )


def timeliness(df: DataFrame, timestamp_column: str | None = None, as_of=None,
               config: QualityConfig = QualityConfig(), by=()) -> DataFrame:
    if _no_columns(df):
        return _constant(df, "timeliness", 1.0)
    return _single(df, timeliness_parts(_field(df, timestamp_column), as_of, config), "timeliness", by)


def _field(df: DataFrame, name: str | None) -> T.StructField | None:
    return next((f for f in df.schema.fields if f.name == name), None)


def outliers(df: DataFrame, by=()) -> DataFrame:
    """(column, outlier_share, score) of every numeric column with a value."""
    fields = columns_of(df, by)
    keys = [named(b) for b in by]
    frame = outlier_frame(df, by)
    if frame is None:
        raise ValueError("no numeric column")
    rows = F.array(
        *[
            F.struct(F.lit(f.name).alias("column"), F.col(f"out_{i}").alias("outlier_share"))
            for i, f in enumerate(fields)
            if isinstance(f.dataType, T.NumericType)
        ]
    )
    return (
        frame.select(*keys, F.inline(rows))
        .where(F.col("outlier_share").isNotNull())
        .withColumn("score", 1.0 - F.col("outlier_share"))
    )


def text_quality_by_column(df: DataFrame, config: QualityConfig = QualityConfig(), by=()) -> DataFrame:
    """(column, score) of every text column."""
    fields = columns_of(df, by)
    aggregates, _ = text_accuracy_parts(fields, config)
    keys = [named(b) for b in by]
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.coalesce(F.col(f"quality_{i}"), F.lit(0.0)).alias("score"),
            )
            for i, f in enumerate(fields)
            if isinstance(f.dataType, T.StringType)
        ]
    )
    return df.groupBy(*keys).agg(*aggregates).select(*keys, F.inline(rows))


def accuracy(df: DataFrame, config: QualityConfig = QualityConfig(), by=()) -> DataFrame:
    if _no_columns(df):
        return _constant(df, "accuracy", 0.0)
    fields = columns_of(df, by)
    keys = [named(b) for b in by]
    aggregates, text_scores = text_accuracy_parts(fields, config)
    frames = [df.groupBy(*keys).agg(_n_rows(), *aggregates)]
    outlier = outlier_frame(df, by)
    if outlier is not None:
        frames.append(outlier)
    score = mean_of(outlier_scores(fields) + text_scores, 0.0)
    return stack(frames, by).select(*keys, _unless_empty(score).alias("accuracy"))


def overall_score() -> Column:
    total = F.lit(0.0)
    for name, weight in DIMENSION_WEIGHTS.items():
        total = total + F.col(name) * weight
    return total


def profile(
    df: DataFrame,
    config: QualityConfig = QualityConfig(),
    timestamp_column: str | None = None,
    as_of=None,
    references: dict | None = None,
    by=(),
) -> DataFrame:
    """One row (per group) with the seven scores and ``overall_score``.

    ``references`` maps a column to its (parent frame, parent column); columns named
    ``*_id`` or ``*_ref`` without an entry count as intact.
    """
    by = tuple(by)
    fields = columns_of(df, by)
    keys = [named(b) for b in by]
    if not fields:
        row = df.sparkSession.range(1).select(
            *[F.lit(1.0 if d == "timeliness" else 0.0).alias(d) for d in QUALITY_DIMENSIONS]
        )
        return row.select("*", overall_score().alias("overall_score"))

    complete = completeness_parts(fields)
    consistent = consistency_parts(fields)
    valid = validity_parts(fields, config)
    timely = timeliness_parts(_field(df, timestamp_column), as_of, config)
    quality_aggregates, text_scores = text_accuracy_parts(fields, config)
    slots = distinct_slots(fields)

    first_pass = [
        *complete.aggregates, *consistent.aggregates, *valid.aggregates, *timely.aggregates,
        *quality_aggregates,
    ]
    if config.approximate_distinct:
        first_pass += approximate_distinct_aggregates(slots)
    frames = [df.groupBy(*keys).agg(*_unique_aliases(first_pass))]
    if not config.approximate_distinct:
        frames.append(distinct_counts(df, slots, by))
    outlier = outlier_frame(df, by)
    if outlier is not None:
        frames.append(outlier)
    names = reference_columns(fields)
    shares = found_shares(df, references or {}, by)
    frames += list(shares.values())

    integrity_scores = [
        F.coalesce(F.col(f"found_{c}"), F.lit(1.0)) if c in shares else F.lit(1.0)
        for c in dict.fromkeys([*names, *shares])
    ]
    return (
        stack(frames, by)
        .select(
            *keys,
            complete.score.alias("completeness"),
            consistent.score.alias("consistency"),
            valid.score.alias("validity"),
            uniqueness_score(fields).alias("uniqueness"),
            timely.score.alias("timeliness"),
            _unless_empty(mean_of(integrity_scores, 1.0)).alias("integrity"),
            _unless_empty(mean_of(outlier_scores(fields) + text_scores, 0.0)).alias("accuracy"),
        )
        .select("*", overall_score().alias("overall_score"))
    )


def verdict(scores: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Add ``issues`` and ``passed`` to the rows of a profile."""
    checked = {"completeness": config.min_completeness, "consistency": config.min_consistency}
    if config.strict:
        checked |= {
            "validity": config.min_validity,
            "uniqueness": config.min_uniqueness,
            "accuracy": config.min_accuracy,
        }
    issues = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(name) < floor,
                    F.concat(
                        F.lit(f"{name.capitalize()} score "),
                        two_decimals(F.col(name)),
                        F.lit(f" below threshold {floor}"),
                    ),
                )
                for name, floor in checked.items()
            ]
        )
    )
    return scores.withColumn("issues", issues).withColumn(
        "passed",
        (F.size("issues") == 0) & (F.col("overall_score") >= config.min_overall_score),
    )


def validate(df: DataFrame, config: QualityConfig = QualityConfig(), **options) -> DataFrame:
    """Profile and verdict in one row (per group)."""
    return verdict(profile(df, config, **options), config)
