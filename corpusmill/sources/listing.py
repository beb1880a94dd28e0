"""Find datasets below a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Extensions that make a file a dataset (case counts), and the
# folder whose content never is one.
DATASET_EXTENSIONS = ("csv", "json", "txt", "jsonl")
IGNORED_FOLDER = "/.git/"


def _qualified(spark: SparkSession, uri: str) -> str:
    """The URI as file status shows it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def list_datasets(spark: SparkSession, uri: str, extensions=DATASET_EXTENSIONS) -> DataFrame:
    """(path, extension, files, bytes) of all datasets below ``uri``.

    A dataset is a file with one of the extensions, or a folder with one: what Spark
    writes to ``x.csv`` is one dataset, however many part files it has. Only file
    status is selected, so no file is opened.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(uri)
        .select("path", F.col("length").alias("bytes"))
        .where(~F.col("path").contains(IGNORED_FOLDER))
    )
    # The topmost folder or file below ``uri`` with a dataset's extension; ``uri`` itself if it is one file.
    ending = "|".join(extensions)
    base = _qualified(spark, uri)
    inside = F.col("path").startswith(base)
    below = F.when(inside, F.substring("path", len(base) + 1, 1 << 30)).otherwise(F.col("path"))
    part = F.regexp_extract(below, rf"^((?:/.*?)?[^/]*\.({ending}))(?:/|$)", 1)
    whole = F.when(below == "", F.regexp_extract("path", rf"^.*\.({ending})$", 0)).otherwise("")
    root = F.when(part != "", F.concat(F.when(inside, base).otherwise(""), part)).otherwise(whole)
    return (
        files.withColumn("dataset", root)
        .where(F.col("dataset") != "")
        .groupBy(F.col("dataset").alias("path"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
        .select("path", F.element_at(F.split("path", r"\."), -1).alias("extension"), "files", "bytes")
    )
