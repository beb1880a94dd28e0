"""Line dedup: explode normalised lines, hash, count the documents of each hash, drop, reassemble."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import named
from .common import ASCII_BLANKS, ascii_lower, free_name, keyed_texts, saved


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _kept(lines: Column, dropped: Column) -> Column:
    """The lines between the dropped places (ascending, from 0), by slices: linear in the lines."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + 1))
    ends = F.concat(dropped, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a)))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, version, place, h1, h2): each line whose key has ``min_chars`` code points or more.

    The key is the line without ASCII white space at both ends and with A-Z lower-cased; two
    64-bit hashes stand for it. ``version`` tells rows with the same id and other texts apart.
    """
    lines = docs.select(
        "doc", F.xxhash64("text").alias("version"), F.posexplode(_lines(F.col("text"))).alias("place", "line")
    )
    bare = F.trim(F.col("line"), F.lit(ASCII_BLANKS))
    return (
        lines.select("doc", "version", "place", bare.alias("bare"))
        .where(F.char_length("bare") >= min_chars)
        .select("doc", "version", "place", ascii_lower(F.col("bare")).alias("line_key"))
        .select(
            "doc",
            "version",
            "place",
            F.xxhash64("line_key").alias("h1"),
            F.xxhash64(F.lit(1), "line_key").alias("h2"),
        )
    )


def drop_repeated_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """The input with ``text`` cleaned, and n_lines and n_dropped added (under free names).

    A line whose key occurs in ``min_docs`` documents or more stays only in the smallest id
    that has it, there every time. A null or empty text is one empty line and stays as it is
    (a null becomes empty). Rows with one id are one document; a null id counts as the
    smallest. Repeated rows give equal results. An empty table gives an empty table.

    Line texts never leave their rows: what is shuffled is hashes, and each text once to meet
    the places that it loses. Counts combine before the shuffle; the repeated keys are a
    written table, so that the join of a very frequent line can be split by AQE.
    """
    source = keyed_texts(docs, key, text)
    owner = F.struct(F.col("doc").isNotNull().alias("filled"), F.col("doc").alias("id"))
    hashed = line_hashes(source, min_chars).withColumn("owner", owner).drop("doc")
    repeated = saved(
        hashed.groupBy("h1", "h2")
        .agg(F.count_distinct("owner").alias("n"), F.min("owner").alias("first"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "first"),
        "repeated-lines",
    )
    losses = (
        hashed.join(repeated, ["h1", "h2"])
        .where(F.col("owner") != F.col("first"))
        .groupBy("owner", "version")
        .agg(F.collect_set("place").alias("places"))
        .select(
            F.col("owner.id").alias("loss_id"),
            F.col("version").alias("loss_version"),
            F.sort_array("places").alias("places"),
        )
    )
    rows = docs.select(
        F.struct(*[named(c) for c in docs.columns]).alias("row"),
        named(key).alias("doc"),
        F.coalesce(named(text).cast("string"), F.lit("")).alias("text"),
    )
    met = rows.join(
        losses,
        F.col("doc").eqNullSafe(F.col("loss_id")) & (F.xxhash64("text") == F.col("loss_version")),
        "left",
    )
    lines = _lines(F.col("text"))
    cleaned = F.when(F.col("places").isNull(), F.col("text")).otherwise(
        F.array_join(_kept(lines, F.col("places")), "\n")
    )
    n_lines, n_dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    return met.select(
        *[
            cleaned.alias(c) if c == text else F.col("row").getField(c).alias(c)
            for c in docs.columns
        ],
        F.size(lines).cast("bigint").alias(n_lines),
        F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias(n_dropped),
    )
