"""A Bloom filter of a column, built by aggregation and tested in the scan.

It tells for most values that a large table lacks them, before they are shuffled to meet it. Its size
is bounded whatever the table's: beyond ``MAX_BITS`` more values pass that are not there, and meet the
table in vain; a value that is there always passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import named
from ..session import written

MAX_BITS = 1 << 26
BITS_PER_VALUE = 10
PROBES = 5
# Types whose equal values have one hash; decimals do where precision and scale agree.
_HASHABLE = (
    T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType,
    T.TimestampNTZType, T.DecimalType, T.BinaryType, T.BooleanType,
)


def can_filter(value_type: T.DataType, key_type: T.DataType) -> bool:
    """Whether equal values of both columns have equal hashes."""
    return value_type == key_type and isinstance(value_type, _HASHABLE)


class BloomFilter:
    """``words`` (word, mask) is a written table with a row for each 64 bits."""

    def __init__(self, words: DataFrame, bits: int):
        self.words = words
        self.bits = bits

    @classmethod
    def of(cls, table: DataFrame, column: str) -> "BloomFilter":
        """Of the values of a column; nulls are left out. Bits combine in the map tasks, so each hands
        over at most one row per 64 bits."""
        keys = table.where(named(column).isNotNull()).select(named(column).alias("key"))
        wanted = BITS_PER_VALUE * max(1, keys.count())
        bits = min(MAX_BITS, 1 << max(10, (wanted - 1).bit_length()))
        empty = table.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("mask"))
        place = F.explode(F.array(*cls._places(F.col("key"), bits)))
        filled = keys.select(place.alias("place")).select(
            F.shiftright("place", 6).alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int")).alias("mask"),
        )
        words = filled.union(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
        return cls(written(words, "bloom-filter"), bits)

    @staticmethod
    def _places(key: Column, bits: int) -> list[Column]:
        h = F.xxhash64(key)
        start, step = h.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftrightunsigned(h, 33)
        return [(start + F.lit(i) * step) % F.lit(bits) for i in range(PROBES)]

    def might_hold(self, key: Column) -> Column:
        """False for most values that were not there, true for all that were; null for null. Not for use
        inside a lambda: the bits are a scalar subquery."""
        pairs = F.sort_array(F.collect_list(F.struct("word", "mask")))
        bits = self.words.agg(F.transform(pairs, lambda p: p["mask"]).alias("bits")).scalar()
        found = None
        for place in self._places(key, self.bits):
            word = F.get(bits, F.shiftright(place, 6).cast("int"))
            is_set = F.getbit(word, (place % 64).cast("int")) == 1
            found = is_set if found is None else found & is_set
        return F.when(key.isNotNull(), found)
