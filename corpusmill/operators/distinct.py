"""Distinct counts of rows and of text columns in one job, over digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import named

ROWS = -1
_ALL_FIELDS = {"ignoreNullFields": "false"}


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType))


def _with_sorted_maps(value: Column, kind: T.DataType) -> Column:
    """The value with every map, however deep, as an array of entries sorted by key."""
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _with_sorted_maps(v, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_with_sorted_maps(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                F.to_json(F.struct(_with_sorted_maps(e["key"], kind.keyType).alias("k")), _ALL_FIELDS).alias("key"),
                F.to_json(F.struct(_with_sorted_maps(e["value"], kind.valueType).alias("v")), _ALL_FIELDS).alias("value"),
            ),
        )
        return F.sort_array(entries)
    return value


def _hashable(field: T.StructField) -> Column:
    """Nested values as JSON text, nulls kept and map entries in order; others as they are."""
    column = named(field.name)
    if not _nested(field.dataType):
        return column
    return F.to_json(F.struct(_with_sorted_maps(column, field.dataType).alias("c")), _ALL_FIELDS)


def row_digest(fields: list[T.StructField]) -> list[Column]:
    """Two 64-bit hashes with unlike seeds, 128 bits in all.

    Spark's hash skips nulls, so every value is preceded by its null flag.
    """
    parts = []
    for f in fields:
        parts += [named(f.name).isNull(), _hashable(f)]
    return [F.xxhash64(F.lit("first"), *parts), F.xxhash64(F.lit("second"), *parts)]


def distinct_counts(
    df: DataFrame, slots: dict[int, list[T.StructField]], by: tuple[str, ...] = ()
) -> DataFrame:
    """Per group the number of distinct values of each slot, as column ``d<slot>``.

    A slot is a list of columns; single columns are counted without nulls. Each row
    contributes one 20-byte digest per slot. Copies meet inside the map tasks
    first, so that neither wide rows nor frequent values are shuffled.
    """
    digests = []
    for slot, fields in slots.items():
        one, two = row_digest(fields)
        entry = F.struct(F.lit(slot).alias("slot"), one.alias("h1"), two.alias("h2"))
        if slot != ROWS:
            entry = F.when(named(fields[0].name).isNotNull(), entry)
        digests.append(entry)
    keys = [named(b) for b in by]
    flat = (
        df.select(*keys, F.inline(F.array(*digests)))
        .where(F.col("slot").isNotNull())
        .distinct()
        .groupBy(*keys)
        .agg(*[F.count_if(F.col("slot") == s).alias(distinct_alias(s)) for s in slots])
    )
    return flat


def distinct_alias(slot: int) -> str:
    return "d_rows" if slot == ROWS else f"d{slot}"


def approximate_distinct_aggregates(slots: dict[int, list[T.StructField]]) -> list[Column]:
    """The same columns by HyperLogLog++, to be part of another aggregation."""
    result = []
    for slot, fields in slots.items():
        one, _ = row_digest(fields)
        if slot != ROWS:
            one = F.when(named(fields[0].name).isNotNull(), one)
        result.append(F.approx_count_distinct(one).alias(distinct_alias(slot)))
    return result
