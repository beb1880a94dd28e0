"""Validation rules. A rule turns a table into issues and statistics, as tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SpecialCharacterConfig
from ..functions import patterns as P
from ..functions.scoring import is_checkable_text, special_character_ratio, without_markup
from ..functions.text import keep_rows, named, parse_time, two_decimals
from ..session import scratch_path
from .language import LanguageModel, has_trigrams

SNIPPET_CHARS = 50


@dataclass
class RuleResult:
    """``issues`` (rule, column, row_key, message), rule-specific ``stats``, and
    ``passed``, a frame of one Boolean. All lazy."""

    issues: DataFrame
    stats: DataFrame

    @property
    def passed(self) -> DataFrame:
        return self.issues.agg((F.count(F.lit(1)) == 0).alias("passed"))


class Rule:
    """Base of all rules: subclass and define ``issues`` and ``stats``."""

    name = "rule"
    dimension = "validity"
    description = ""
    severity = "medium"

    def issues(self, df: DataFrame, row_key: str | None = None) -> DataFrame:
        raise NotImplementedError

    def stats(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def validate(self, df: DataFrame, row_key: str | None = None) -> RuleResult:
        return RuleResult(self.issues(df, row_key), self.stats(df))

    def _issue(self, column: Column, row_key: Column, message: Column) -> list[Column]:
        return [
            F.lit(self.name).alias("rule"),
            column.alias("column"),
            row_key.cast("string").alias("row_key"),
            message.alias("message"),
        ]


def _key(row_key: str | None) -> Column:
    return F.lit(None).cast("string") if row_key is None else named(row_key)


def _text_columns(df: DataFrame, row_key: str | None = None) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name != row_key
    ]


def _texts(df: DataFrame, row_key: str | None) -> DataFrame:
    """(row_key, column, text) for every non-null text, in one pass over the table."""
    columns = _text_columns(df, row_key)
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), named(c).alias("text")) for c in columns]
    ) if columns else F.array().cast("array<struct<column:string,text:string>>")
    return df.select(_key(row_key).alias("row_key"), F.inline(entries)).where(
        F.col("text").isNotNull()
    )


def _column_names(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(c,) for c in columns], "column string")


class SpecialCharacterRule(Rule):
    """Too many special characters in a text."""

    name = "Special Character Validation"
    description = "Checks for excessive or invalid special characters"

    def __init__(self, config: SpecialCharacterConfig = SpecialCharacterConfig()):
        self.config = config

    def _ratios(self, df: DataFrame, row_key: str | None) -> DataFrame:
        stripped = _texts(df, row_key).withColumn(
            "text", without_markup(F.col("text"), self.config)
        )
        return stripped.withColumn(
            "ratio", special_character_ratio(F.col("text"), self.config)
        )

    def issues(self, df: DataFrame, row_key: str | None = None) -> DataFrame:
        high = keep_rows(
            self._ratios(df, row_key),
            lambda row: row["ratio"] > self.config.max_special_char_ratio,
        )
        message = F.concat(
            F.lit("High special character ratio ("),
            two_decimals(F.col("ratio")),
            F.lit(") in text: "),
            F.substring("text", 1, SNIPPET_CHARS),
            F.lit("..."),
        )
        return high.select(*self._issue(F.col("column"), F.col("row_key"), message))

    def stats(self, df: DataFrame) -> DataFrame:
        """(column, avg_ratio, max_ratio, violations), zeros for a column without texts."""
        measured = self._ratios(df, None).groupBy("column").agg(
            F.avg("ratio").alias("avg_ratio"),
            F.max("ratio").alias("max_ratio"),
            F.count_if(F.col("ratio") > self.config.max_special_char_ratio).alias("violations"),
        )
        columns = _column_names(df, _text_columns(df))
        return F.broadcast(columns).join(measured, "column", "left").select(
            "column",
            F.coalesce("avg_ratio", F.lit(0.0)).alias("avg_ratio"),
            F.coalesce("max_ratio", F.lit(0.0)).alias("max_ratio"),
            F.coalesce("violations", F.lit(0)).alias("violations"),
        )


class LanguageConsistencyRule(Rule):
    """Texts, or too large a part of a column, in another language than expected."""

    name = "Language Consistency"
    dimension = "consistency"
    description = "Checks if text content is consistently in the expected language"
    severity = "high"
    # Confidence from which a foreign text is an issue, and the
    # shortest text that is looked at.
    min_confidence = 0.8
    min_chars = 10

    def __init__(self, model: LanguageModel, primary_language: str = "en", threshold: float = 0.8):
        self.model = model
        self.primary_language = primary_language
        self.threshold = threshold

    def detected(self, df: DataFrame, row_key: str | None = None) -> DataFrame:
        """(row_key, column, text, language, confidence) of every text with a language."""
        texts = _texts(df, row_key).where(
            is_checkable_text(F.col("text"), self.min_chars) & has_trigrams(F.col("text"))
        )
        return self.model.detect(texts, "text", "_found").select(
            "row_key", "column", "text", "_found.*"
        )

    def _foreign(self, language: Column, confidence: Column) -> Column:
        return (language != self.primary_language) & (confidence > self.min_confidence)

    def issues(self, df: DataFrame, row_key: str | None = None) -> DataFrame:
        return self._issues_of(self._written(df, row_key))

    def _issues_of(self, scored: DataFrame) -> DataFrame:
        message = F.concat(
            F.lit("Text detected as "),
            F.col("language"),
            F.lit(" (confidence: "),
            two_decimals(F.col("confidence")),
            F.lit("): "),
            F.substring("text", 1, SNIPPET_CHARS),
            F.lit("..."),
        )
        foreign = scored.where(self._foreign(F.col("language"), F.col("confidence")))
        rows = foreign.select(*self._issue(F.col("column"), F.col("row_key"), message))
        low = self._stats_of(scored).where(F.col("primary_language_ratio") < self.threshold)
        column_message = F.concat(
            F.lit("Column "),
            F.col("column"),
            F.lit(" has low primary language ratio: "),
            two_decimals(F.col("primary_language_ratio")),
        )
        return rows.unionByName(
            low.select(*self._issue(F.col("column"), F.lit(None), column_message))
        )

    def stats(self, df: DataFrame) -> DataFrame:
        """(column, primary_language_ratio, detected_languages, violations)."""
        return self._stats_of(self.detected(df))

    def validate(self, df: DataFrame, row_key: str | None = None) -> RuleResult:
        scored = self._written(df, row_key)
        return RuleResult(self._issues_of(scored), self._stats_of(scored))

    def _written(self, df: DataFrame, row_key: str | None) -> DataFrame:
        """What was detected, written, so that each text is scored once for rows and columns."""
        path = scratch_path(df.sparkSession, "languages")
        self.detected(df, row_key).withColumn(
            "text", F.substring("text", 1, SNIPPET_CHARS)
        ).write.parquet(path)
        return df.sparkSession.read.parquet(path)

    def _stats_of(self, scored: DataFrame) -> DataFrame:
        return scored.groupBy("column").agg(
            F.avg((F.col("language") == self.primary_language).cast("double")).alias(
                "primary_language_ratio"
            ),
            F.sort_array(F.collect_set("language")).alias("detected_languages"),
            F.count_if(self._foreign(F.col("language"), F.col("confidence"))).alias(
                "violations"
            ),
        )


class DataFormatRule(Rule):
    """Values that do not have the format their column's name asks for."""

    name = "Data Format"
    description = "Validates data format consistency"
    severity = "high"
    examples_per_column = 5

    def __init__(self, format_patterns: dict[str, str] | None = None,
                 column_formats: dict[str, str] | None = None):
        """``format_patterns``: regex (Java dialect) by format name, tried in order
        against the lower-cased column name. ``column_formats`` names the format of
        single columns and overrides that."""
        self.patterns = format_patterns or P.FORMATS
        self.column_formats = column_formats or {}

    def formats_of(self, df: DataFrame) -> dict[str, str]:
        found = {}
        for column in df.columns:
            if column in self.column_formats:
                found[column] = self.column_formats[column]
                continue
            kind = next((k for k in self.patterns if k in column.lower()), None)
            if kind:
                found[column] = kind
        return found

    def invalid(self, df: DataFrame, row_key: str | None = None) -> DataFrame:
        """(row_key, column, format_type, value) of every invalid value."""
        entries = []
        types = {f.name: f.dataType for f in df.schema.fields}
        for column, kind in self.formats_of(df).items():
            value = named(column)
            bad = value.isNotNull()
            if isinstance(types[column], T.StringType):
                bad = bad & ~value.rlike(self.patterns[kind])
            entries.append(
                F.when(
                    bad,
                    F.struct(
                        F.lit(column).alias("column"),
                        F.lit(kind).alias("format_type"),
                        value.cast("string").alias("value"),
                    ),
                )
            )
        listed = F.array(*entries) if entries else F.array().cast(
            "array<struct<column:string,format_type:string,value:string>>"
        )
        return df.select(_key(row_key).alias("row_key"), F.inline(listed)).where(
            F.col("column").isNotNull()
        )

    def stats(self, df: DataFrame) -> DataFrame:
        """(column, format_type, invalid_count), only columns with invalid values."""
        return self.invalid(df).groupBy("column", "format_type").agg(
            F.count(F.lit(1)).alias("invalid_count")
        )

    def issues(self, df: DataFrame, row_key: str | None = None) -> DataFrame:
        message = F.concat(
            F.lit("Column "), F.col("column"), F.lit(" ("), F.col("format_type"),
            F.lit(") has "), F.col("invalid_count").cast("string"),
            F.lit(" invalid format values"),
        )
        return self.stats(df).select(*self._issue(F.col("column"), F.lit(None), message))

    def examples(self, df: DataFrame, row_key: str) -> DataFrame:
        """The first few invalid values of each column in the order of ``row_key``.

        A rank with a small limit: Spark keeps the first few of each task before it
        shuffles, so a column full of invalid values does not meet in one task.
        """
        order = Window.partitionBy("column").orderBy("row_key", "value")
        return (
            self.invalid(df, row_key)
            .withColumn("position", F.row_number().over(order))
            .where(F.col("position") <= self.examples_per_column)
            .select("column", "format_type", F.col("position").cast("bigint").alias("position"), "value")
        )


@dataclass(frozen=True)
class Relationship:
    fields: tuple
    violation: Callable[[DataFrame], DataFrame] | Column
    description: str


class CrossFieldConsistencyRule(Rule):
    """Relationships between the columns of a row."""

    name = "Cross-field Consistency"
    dimension = "consistency"
    description = "Validates consistency between related fields"
    severity = "high"

    def __init__(self, relationships=()):
        self.relationships = list(relationships)

    def add_relationship(self, fields, violation, description: str) -> "CrossFieldConsistencyRule":
        """``violation`` is a Boolean Column, true for a violating row, or a function
        from the frame of ``fields`` to the frame of its violating rows."""
        self.relationships.append(Relationship(tuple(fields), violation, description))
        return self

    def _missing(self, df: DataFrame, r: Relationship) -> list[str]:
        return [f for f in r.fields if f not in df.columns]

    def _split(self, df: DataFrame) -> tuple[list, list, list[tuple[str, str]]]:
        """Usable predicates, (relationship, frame of violations) pairs, and what fails, as
        (fields, message).

        A relationship that cannot be analysed on this table is an issue; the others run.
        """
        predicates, frames, failing = [], [], []
        for r in self.relationships:
            fields = "+".join(r.fields)
            if missing := self._missing(df, r):
                failing.append((fields, f"Missing required fields for validation: {missing}"))
                continue
            try:
                if isinstance(r.violation, Column):
                    df.select(r.violation.cast("boolean")).schema  # noqa: B018 - analyses the expression
                    predicates.append(r)
                else:
                    bad = r.violation(df.select(*[named(f) for f in r.fields]))
                    bad.schema  # noqa: B018
                    frames.append((r, bad))
            except Exception as error:  # noqa: BLE001 - reported as an issue
                failing.append((fields, f"Validation failed for fields {list(r.fields)}: {str(error).splitlines()[0] if str(error) else type(error).__name__}"))
        return predicates, frames, failing

    def _counts(self, df: DataFrame, predicates: list, violations: list) -> DataFrame:
        frames = []
        if predicates:
            counted = df.agg(
                *[F.count_if(r.violation).alias(f"v{i}") for i, r in enumerate(predicates)]
            )
            rows = F.array(
                *[
                    F.struct(
                        F.lit("+".join(r.fields)).alias("fields"),
                        F.lit(r.description).alias("description"),
                        F.col(f"v{i}").alias("violations"),
                    )
                    for i, r in enumerate(predicates)
                ]
            )
            frames.append(counted.select(F.inline(rows)))
        for r, bad in violations:
            frames.append(
                bad.agg(F.count(F.lit(1)).alias("violations")).select(
                    F.lit("+".join(r.fields)).alias("fields"),
                    F.lit(r.description).alias("description"),
                    "violations",
                )
            )
        if not frames:
            return df.sparkSession.createDataFrame(
                [], "fields string, description string, violations bigint"
            )
        result = frames[0]
        for f in frames[1:]:
            result = result.unionByName(f)
        return result

    def stats(self, df: DataFrame) -> DataFrame:
        """(fields, description, violations); all predicates share one pass."""
        predicates, violations, _ = self._split(df)
        return self._counts(df, predicates, violations)

    def issues(self, df: DataFrame, row_key: str | None = None) -> DataFrame:
        message = F.concat(
            F.lit("Found "), F.col("violations").cast("string"), F.lit(" violations of: "),
            F.col("description"),
        )
        predicates, violations, absent = self._split(df)
        found = self._counts(df, predicates, violations).where(F.col("violations") > 0).select(
            *self._issue(F.col("fields"), F.lit(None), message)
        )
        if not absent:
            return found
        rows = df.sparkSession.createDataFrame(absent, "fields string, text string")
        return found.unionByName(
            rows.select(*self._issue(F.col("fields"), F.lit(None), F.col("text")))
        )


def date_order(df: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row: start_after_end, unparsable, passed. A null date violates nothing."""

    def as_time(name: str) -> Column:
        column = named(name)
        text = isinstance(df.schema[name].dataType, T.StringType)
        return parse_time(column) if text else column.cast("timestamp_ntz")

    def unreadable(name: str) -> Column:
        return named(name).isNotNull() & as_time(name).isNull()

    return df.agg(
        F.count_if(as_time(start) > as_time(end)).alias("start_after_end"),
        F.count_if(unreadable(start) | unreadable(end)).alias("unparsable"),
    ).withColumn("passed", (F.col("start_after_end") == 0) & (F.col("unparsable") == 0))


def date_order_violation(start: str = "start_date", end: str = "end_date") -> Column:
    """For string columns, as a relationship of the cross-field rule."""
    return F.coalesce(
        parse_time(named(start)) > parse_time(named(end)), F.lit(False)
    )


def all_issues(df: DataFrame, rules: list[Rule], row_key: str | None = None) -> DataFrame:
    """The issues of several rules in one table."""
    result = rules[0].issues(df, row_key)
    for rule in rules[1:]:
        result = result.unionByName(rule.issues(df, row_key))
    return result
