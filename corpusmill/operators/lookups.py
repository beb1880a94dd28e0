"""Small vocabularies (lexicons, gazetteers, tag lists) for row-level operators.

A vocabulary of at most ``MAX_LITERAL_ENTRIES`` entries, checked by reading one
entry more, is written into the expression as hash sets: no join, no shuffle. A
larger one is joined: the distinct candidates of each text that pass a Bloom filter meet the
vocabulary, frequent ones in a broadcast join and others in a shuffle join, and each row gets a map of
its own matches. The row-level expressions are the same for both.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import named
from ..session import written
from .bloom import BloomFilter

MAX_LITERAL_ENTRIES = 5000
# Distinct values that a lookup tells apart by branches of one CASE.
MAX_BRANCHES = 32
# Entries with this share of all probes ("the") are broadcast.
HOT_SHARE = 1e-5


class LiteralLookup:
    """Lookup of a bounded ``{key: value}`` inside an expression."""

    def __init__(self, entries: dict):
        self.entries = dict(entries)

    def contains(self, key: Column) -> Column:
        if not self.entries:
            return F.lit(False)
        return key.isin(*self.entries)

    def value(self, key: Column) -> Column:
        """The entry's value or null: a hash set per distinct value while these are few, else
        one list of keys and one of values, whatever the number of values."""
        keys_of = defaultdict(list)
        for k, v in self.entries.items():
            keys_of[v].append(k)
        if len(keys_of) > MAX_BRANCHES:
            keys = sorted(self.entries)
            place = F.array_position(F.lit(keys), key)
            values = F.lit([self.entries[k] for k in keys])
            return F.when(key.isin(*keys), F.try_element_at(values, place.cast("int")))
        result = None
        for v, keys in sorted(keys_of.items(), key=lambda kv: str(kv[0])):
            result = F.when(key.isin(*keys), F.lit(v)) if result is None else result.when(key.isin(*keys), F.lit(v))
        return F.lit(None) if result is None else result


class RowLookup:
    """Lookup in a map column that holds each row's own matches."""

    def __init__(self, matches: Column):
        self.matches = matches

    def contains(self, key: Column) -> Column:
        return F.coalesce(F.map_contains_key(self.matches, key), F.lit(False))

    def value(self, key: Column) -> Column:
        return F.try_element_at(self.matches, key)


def read_bounded(table: DataFrame, key: str, value: str, limit: int = MAX_LITERAL_ENTRIES):
    """The table as a dict, or None when it has more than ``limit`` entries.

    Keys must not carry two values; the smallest is taken when they do.
    """
    distinct = one_value_per_key(table, key, value)
    rows = distinct.limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return {r[0]: r[1] for r in rows}


def one_value_per_key(table: DataFrame, key: str, value: str) -> DataFrame:
    return (
        table.where(named(key).isNotNull())
        .groupBy(named(key).alias("_entry"))
        .agg(F.min(named(value)).alias("_value"))
    )


def probes_of(df: DataFrame, row_key: str, candidates: Column) -> DataFrame:
    """(_row, _entry): the distinct ``candidates`` of each row."""
    return df.select(named(row_key).alias("_row"), F.explode(F.array_distinct(candidates)).alias("_entry"))


def text_hash(text: Column) -> Column:
    """Tells the texts of rows apart whose key is the same."""
    return F.xxhash64(text)


def attach_matches(
    df: DataFrame, row_key: str, probes: DataFrame, table: DataFrame, key: str, value: str, out: str
) -> DataFrame:
    """Add ``out``, a map of those ``probes`` (_row, _entry) of each row that ``table`` holds.

    ``row_key`` must be unique.
    """
    matches = matched(probes, table, key, value).groupBy("_row").agg(
        F.map_from_entries(F.collect_set(F.struct("_entry", "_value"))).alias(out)
    )
    return df.join(matches, named(row_key) == F.col("_row"), "left").drop("_row")


def attach_places(
    df: DataFrame, row_key: str, text_col: str, probes: DataFrame, table: DataFrame, key: str, value: str,
    out: str, out_map: str,
) -> DataFrame:
    """Add ``out``, an array of (at, span, value) of those ``probes`` (_row, _text, _at, _span, _entry) of
    each text that ``table`` holds, sorted by ``at``.

    What a row-level expression needs of a large vocabulary comes with its place in the text, so that it
    searches nothing: a map would be searched from its beginning for each piece of the text. For texts
    made of this one there is a map all the same, as ``out_map``; Spark leaves it out where it is not used.
    """
    place = F.struct(F.col("_at").alias("at"), F.col("_span").alias("span"), F.col("_value").alias("value"))
    matches = matched(probes, table, key, value).groupBy("_row", "_text").agg(
        F.sort_array(F.collect_set(place)).alias(out),
        F.map_from_entries(F.collect_set(F.struct("_entry", "_value"))).alias(out_map),
    )
    same = (named(row_key) == F.col("_row")) & (text_hash(named(text_col)) == F.col("_text"))
    return df.join(matches, same, "left").drop("_row", "_text")


def matched(probes: DataFrame, table: DataFrame, key: str, value: str) -> DataFrame:
    """Those ``probes`` (..., _entry) that ``table`` holds, with its value as ``_value``.

    A Bloom filter of the table drops most probes that it lacks before
    they are written and counted. Entries with a share of at least ``HOT_SHARE`` of what is left, of
    which there can only be 1 / ``HOT_SHARE``, are broadcast; only the others meet the table in a
    shuffle join, in which no entry is hot.
    """
    entries = written(one_value_per_key(table, key, value), "vocabulary")
    might_match = BloomFilter.of(entries, "_entry").might_hold(F.col("_entry"))
    left = written(probes.where(might_match), "probes")
    most = HOT_SHARE * left.count()
    hot = written(
        left.groupBy("_entry").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= most).select("_entry")
        .join(entries, "_entry", "left"),
        "hot-entries",
    )
    frequent = left.join(F.broadcast(hot), "_entry").where(F.col("_value").isNotNull())
    rare = left.join(F.broadcast(hot.select("_entry")), "_entry", "left_anti").join(entries, "_entry")
    columns = [*probes.columns, "_value"]
    return frequent.select(*columns).union(rare.select(*columns))
