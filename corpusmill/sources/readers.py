"""Read datasets, and find their text columns."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import named
from ..session import scratch_path
from .ranges import csv_records, json_records

# Cells of a CSV file that mean "no value".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Shapes of numbers and truth values in a CSV cell.
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
DECIMAL = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
TRUTH = r"^(?:True|False|TRUE|FALSE|true|false)$"

FORMATS = {"csv": "csv", "json": "json", "jsonl": "jsonl", "txt": "txt", "parquet": "parquet"}


class UnsupportedFormat(ValueError):
    """The file's extension names no format that can be read."""


def format_of(uri: str) -> str:
    """The format by the lower-cased extension."""
    extension = uri.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
    if extension not in FORMATS:
        raise UnsupportedFormat(f"unsupported file format: .{extension}")
    return FORMATS[extension]


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _cells(df: DataFrame) -> dict[str, tuple[str, float | None]]:
    """(narrowest type, average length) of each string column; the type is one of bigint, double,
    boolean and string.

    One aggregation over all columns; one row reaches the driver. Whole numbers that
    no bigint holds stay text, since a double would merge them.
    """
    strings = _strings(df)
    if not strings:
        return {}

    def every(condition: Column) -> Column:
        return F.coalesce(F.every(condition), F.lit(False))

    measures = []
    for i, c in enumerate(strings):
        cell = named(c)
        whole = cell.rlike(INTEGER)
        held = F.when(cell.isNotNull(), F.trim(cell).try_cast("bigint").isNotNull())
        measures += [
            every(whole & held).alias(f"bigint_{i}"),
            every(cell.rlike(DECIMAL) & (~whole | held)).alias(f"double_{i}"),
            every(cell.rlike(TRUTH)).alias(f"boolean_{i}"),
            F.avg(F.length(cell)).alias(f"length_{i}"),
        ]
    row = df.agg(*measures).first()
    kinds = ("bigint", "double", "boolean")
    return {
        c: (next((k for k in kinds if row[f"{k}_{i}"]), "string"), row[f"length_{i}"])
        for i, c in enumerate(strings)
    }


def _cast(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    def cast(name: str) -> Column:
        kind = kinds.get(name, "string")
        return named(name) if kind == "string" else F.trim(named(name)).cast(kind).alias(name)

    return df.select(*[cast(c) for c in df.columns])


def infer_types(df: DataFrame) -> DataFrame:
    """Cast string columns whose every value is a number or truth value."""
    return _cast(df, {c: kind for c, (kind, _) in _cells(df).items()})


def _without_na(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~named(c).isin(*NA_TOKENS), named(c)).alias(c) for c in df.columns])


def spans_lines(spark: SparkSession, uri: str) -> bool:
    """Whether a cell holds a line break: then some line has an odd number of quotes."""
    lines = spark.read.text(uri)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not lines.where(quotes % 2 == 1).isEmpty()


def _split_bytes(spark: SparkSession) -> int:
    """The size up to which a file is one task's."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def _has_large_file(spark: SparkSession, uri: str) -> bool:
    """Whether some file is larger than one task reads; the files are listed, not read."""
    lengths = spark.read.format("binaryFile").load(uri).select("length")
    return not lengths.where(F.col("length") > _split_bytes(spark)).isEmpty()


def _csv_cells(spark: SparkSession, uri: str, multi_line: bool | None, names=None, split: bool | None = None) -> DataFrame:
    """All cells as text, those that mean "no value" as null."""
    if multi_line is None:
        multi_line = spans_lines(spark, uri)
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if names is not None:
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    cells = reader.option("inferSchema", False).csv(uri)
    if multi_line and (_has_large_file(spark, uri) if split is None else split):
        schema = ", ".join(f"c{i} string" for i in range(len(cells.columns)))
        row = F.from_csv("value", schema, {"multiLine": "true", "escape": '"'})
        rows = csv_records(spark, uri).where(~F.col("first")).select(row.alias("r"))
        cells = rows.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(cells.columns)])
    return _without_na(cells)


def read_csv(spark: SparkSession, uri: str, schema: T.StructType | None = None,
             multi_line: bool | None = None, split: bool | None = None) -> DataFrame:
    """A CSV dataset with header.

    Cells that mean "no value" are null before the types are found or, with a
    ``schema``, cast; a schema saves the pass that finds them, and a cell that does not fit it is an
    error. Large files are split between tasks. Where a cell holds a line break, which a pass over
    the lines finds and ``multi_line`` True or False tells without, a file larger than one task
    reads is cut into records by ranges (see ``ranges``); ``split`` True or False decides that
    for all files.
    """
    if schema is None:
        return infer_types(_csv_cells(spark, uri, multi_line, split=split))
    cells = _csv_cells(spark, uri, multi_line, schema.fieldNames(), split)
    return cells.select(
        *[
            named(f.name) if isinstance(f.dataType, T.StringType)
            else F.trim(named(f.name)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _document_records(text: str) -> Iterator[str]:
    """The records of a JSON document that is no list, each on one line.

    It is a record, or columns of cells (an object of objects that all have the same numbers as
    keys). Anything else is an error.
    """
    value = json.loads(text)
    if not isinstance(value, dict):
        raise ValueError("a JSON document must be a list, a record or columns")
    columns = list(value.values())
    keys = columns[0].keys() if columns and isinstance(columns[0], dict) else ()
    if keys and all(isinstance(c, dict) and c.keys() == keys for c in columns) and all(k.isdigit() for k in keys):
        for k in sorted(keys, key=int):
            yield json.dumps({name: column[k] for name, column in value.items()})
    else:
        # Line breaks stand between tokens only; inside a string they are escaped.
        yield text.replace("\r", " ").replace("\n", " ")


def _documents_as_lines(spark: SparkSession, files: list[str] | str) -> str:
    """Write the records of JSON documents as lines; the folder written."""
    out = scratch_path(spark, "json-records")
    json_records(spark, files, _document_records).write.text(out)
    return out


def read_json(spark: SparkSession, uri: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON files: records by line, or whole-file documents, several to a file if need be.

    A document is a list of records, a record, or columns of cells. A file whose lines
    (two or more) all begin and end as an object does is read by line and split between tasks;
    the documents of any other are cut by ranges (see ``ranges``) and first written as lines. A list
    of any length is split, wherever its line breaks are; a record, and columns of cells, are
    one task's. Malformed documents are an error, not rows of nulls.
    """
    line = F.trim(F.col("value"), F.lit(" \t\r\n"))
    files = (
        spark.read.text(uri)
        .select(F.col("_metadata.file_path").alias("path"), line.alias("line"))
        .where(F.col("line") != "")
        .groupBy("path")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.every(F.col("line").startswith("{") & F.col("line").endswith("}")).alias("objects"),
        )
        .select("path", ((F.col("n") > 1) & F.col("objects")).alias("by_line"))
    )
    n_lines, n_whole = files.agg(F.count_if("by_line"), F.count_if(~F.col("by_line"))).first()

    def paths(by_line: bool) -> list[str]:
        kind = F.col("by_line") if by_line else ~F.col("by_line")
        return [unquote(r["path"]) for r in files.where(kind).select("path").collect()]

    reader = spark.read.option("mode", "FAILFAST")
    reader = reader if schema is None else reader.schema(schema)
    whole = None if n_lines else uri
    by_line = uri
    if n_lines and n_whole:
        whole, by_line = paths(False), paths(True)
    if n_lines or not n_whole:
        records = reader.json(by_line)
        if _is_column_oriented(records.schema):  # such documents, each on a line of its own
            records = reader.json(_documents_as_lines(spark, by_line))
        if whole is None:
            return records
        return records.unionByName(reader.json(_documents_as_lines(spark, whole)), allowMissingColumns=True)
    return reader.json(_documents_as_lines(spark, whole))


def _is_column_oriented(schema: T.StructType) -> bool:
    """Every field is an object, and all have the same numbers as keys."""
    keys = [set(f.dataType.names) if isinstance(f.dataType, T.StructType) else set() for f in schema.fields]
    return bool(keys) and all(k == keys[0] for k in keys) and bool(keys[0]) and all(k.isdigit() for k in keys[0])


def read_dataset(spark: SparkSession, uri: str, fmt: str | None = None,
                 schema: T.StructType | None = None, multi_line: bool | None = None) -> DataFrame:
    """Read by extension, or as ``fmt``. A text file is a table of lines, ``text``.

    ``multi_line`` is that of ``read_csv``.
    """
    fmt = fmt or format_of(uri)
    if fmt == "csv":
        return read_csv(spark, uri, schema, multi_line)
    if fmt == "json":
        return read_json(spark, uri, schema)
    if fmt == "jsonl":
        reader = spark.read.option("mode", "FAILFAST")
        return (reader if schema is None else reader.schema(schema)).json(uri)
    if fmt == "txt":
        return spark.read.text(uri).withColumnRenamed("value", "text")
    if fmt == "parquet":
        return spark.read.parquet(uri)
    raise UnsupportedFormat(f"unsupported file format: {fmt}")


def spread(df: DataFrame, parts: int | None) -> DataFrame:
    """Deal the rows to ``parts`` tasks, a full shuffle; None leaves them as they are.

    For tables whose few input splits would keep few cores busy: text work can cost far
    more than reading. On a table of many splits it only costs.
    """
    return df if parts is None or df.isStreaming else df.repartition(parts)


# Fixed value: a string column whose texts are longer than this on average is text.
MIN_AVERAGE_LENGTH = 10


def read_with_text_columns(spark: SparkSession, uri: str, schema: T.StructType | None = None,
                           multi_line: bool | None = None) -> tuple[DataFrame, list[str]]:
    """A dataset and its text columns. A CSV's types and lengths come from one pass."""
    if format_of(uri) != "csv" or schema is not None:
        df = read_dataset(spark, uri, schema=schema, multi_line=multi_line)
        return df, text_columns(df)
    raw = _csv_cells(spark, uri, multi_line)
    cells = _cells(raw)
    texts = [
        c for c, (kind, length) in cells.items()
        if kind == "string" and length is not None and length > MIN_AVERAGE_LENGTH
    ]
    return _cast(raw, {c: kind for c, (kind, _) in cells.items()}), texts


def text_column_lengths(df: DataFrame) -> DataFrame:
    """(column, average_length, is_text) of every string column, in one pass."""
    strings = _strings(df)
    if not strings:
        return df.sparkSession.createDataFrame(
            [], "column string, average_length double, is_text boolean"
        )
    averages = df.agg(*[F.avg(F.length(named(c))).alias(f"a{i}") for i, c in enumerate(strings)])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"a{i}").alias("average_length"),
                F.coalesce(F.col(f"a{i}") > MIN_AVERAGE_LENGTH, F.lit(False)).alias("is_text"),
            )
            for i, c in enumerate(strings)
        ]
    )
    return averages.select(F.inline(rows))


def text_columns(df: DataFrame) -> list[str]:
    """Names of the text columns, in the order of the frame."""
    return [r["column"] for r in text_column_lengths(df).where("is_text").collect()]
