"""Quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import QUALITY_DIMENSIONS, QualityConfig
from ..functions.text import named, two_decimals
from ..operators.profile import validate
from ..sources.readers import read_dataset
from ..sources.writers import write_table


def dataset_stats(df: DataFrame) -> DataFrame:
    """(rows, columns, memory_usage, column_types). The bytes are those of the rows
    as JSON text, an estimate that does not depend on the storage format."""
    types = F.create_map(*[v for name, kind in df.dtypes for v in (F.lit(name), F.lit(kind))]) if (
        df.columns
    ) else F.create_map().cast("map<string,string>")
    size = F.octet_length(F.to_json(F.struct(*[named(c) for c in df.columns]))) if df.columns else F.lit(0)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(size), F.lit(0)).alias("memory_usage"),
    ).select(
        "rows",
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        "memory_usage",
        types.alias("column_types"),
    )


def quality_report(df: DataFrame, dataset: str, config: QualityConfig = QualityConfig(),
                   timestamp: str | None = None, **options) -> DataFrame:
    """One row: dataset, timestamp, passed, issues, metrics, overall_score, dataset_stats."""
    judged = validate(df, config, **options).select(
        "passed",
        "issues",
        F.struct(*[F.col(d) for d in QUALITY_DIMENSIONS]).alias("metrics"),
        "overall_score",
    )
    counted = dataset_stats(df).select(
        F.struct("rows", "columns", "memory_usage", "column_types").alias("dataset_stats")
    )
    stamp = F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss") if timestamp is None else F.lit(timestamp)
    return judged.withColumn("dataset_stats", counted.scalar()).select(
        F.lit(dataset).alias("dataset"),
        stamp.alias("timestamp"),
        "passed",
        "issues",
        "metrics",
        "overall_score",
        "dataset_stats",
    )


def report_lines(report: DataFrame) -> DataFrame:
    """(dataset, line_no, line): the report as text."""

    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(label), value)

    status = F.when(F.col("passed"), "PASSED").otherwise("FAILED")
    stats = F.col("dataset_stats")
    head = [
        F.lit("=== Data Quality Report ==="),
        F.lit(""),
        line("Dataset: ", F.col("dataset")),
        line("Timestamp: ", F.col("timestamp")),
        line("Overall Status: ", status),
        line("Overall Score: ", two_decimals(F.col("overall_score"))),
        F.lit(""),
        F.lit("--- Quality Metrics ---"),
        *[
            line(f"{d.capitalize()}: ", two_decimals(F.col("metrics").getField(d)))
            for d in QUALITY_DIMENSIONS
        ],
    ]
    issues = F.when(
        F.size("issues") > 0,
        F.concat(
            F.array(F.lit(""), F.lit("--- Issues Found ---")),
            F.transform("issues", lambda i: F.concat(F.lit("- "), i)),
        ),
    ).otherwise(F.array().cast("array<string>"))
    tail = [
        F.lit(""),
        F.lit("--- Dataset Statistics ---"),
        line("Rows: ", stats.getField("rows").cast("string")),
        line("Columns: ", stats.getField("columns").cast("string")),
        F.concat(
            F.lit("Memory Usage: "), stats.getField("memory_usage").cast("string"), F.lit(" bytes")
        ),
    ]
    lines = F.concat(F.array(*head), issues, F.array(*tail))
    return report.select("dataset", F.posexplode(lines).alias("line_no", "line"))


def write_report(report: DataFrame, out: str) -> None:
    """The report as JSON and as text below ``out``. One small row, computed once."""
    write_table(report, f"{out}/json", "json", mode="overwrite")
    spark = report.sparkSession
    written = spark.read.schema(report.schema).json(f"{out}/json")
    lines = report_lines(written).coalesce(1).sortWithinPartitions("line_no").select("line")
    write_table(lines, f"{out}/text", "txt", mode="overwrite")


def analyze_dataset(spark: SparkSession, uri: str, config: QualityConfig = QualityConfig(),
                    out: str | None = None, **options) -> DataFrame:
    """Read a dataset and report on it; written below ``out`` when that is given."""
    report = quality_report(read_dataset(spark, uri), uri, config, **options)
    if out is not None:
        write_report(report, out)
    return report
