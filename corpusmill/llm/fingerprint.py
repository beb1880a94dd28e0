"""Document fingerprints: a homomorphic multiset hash of the paragraphs.

The fingerprint is a vector of sums modulo 2^62. Two wide entries add up 62-bit hashes of
whole paragraphs: they decide equality, whatever the order. The other entries hold 124
counters of 31 bits, two to an entry, to which each piece of a paragraph adds the bits of its
hash. A piece ends where the hash of a word says so, after ``1 / (CUT + 1)`` of the words, so that pieces
move with the text: a word more or less changes the piece it is in and no other. Less half
the number of pieces, the counters are a random-sign projection of the multiset of pieces, so
that the cosine of two fingerprints estimates how much the documents have in common, up to
a standard error of about 0.09. Adding or taking away a paragraph adds or takes away its
vector. No text is long enough for a counter to overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from .common import keyed_texts, saved

CUT = 7  # bits of a word's hash that are all 0 where a piece ends
_SHIFTS = 31
_OFFSETS = (0, 31)
_LANES = sum(1 << at for at in _OFFSETS)
_MODULUS = (1 << 62) - 1
# A word, with the end of its paragraph. Possessive, so that a very long run costs no stack; an overlong word
# counts as several.
_WORD = r"[^ \n]{1,48}+(?: *+\n)?+"
_FIELD = (1 << 31) - 1


def _total(values: Column, of) -> Column:
    modulus = F.lit(_MODULUS)
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, v: (acc + of(v)).bitwiseAND(modulus))


def _hashes(parts: Column, seed: int) -> Column:
    return F.transform(parts, lambda p: F.xxhash64(F.lit(seed), p))


def _bits(hashes: Column) -> list[Column]:
    lanes = F.lit(_LANES)
    return [
        _total(hashes, lambda h, i=i: F.shiftrightunsigned(h, i).bitwiseAND(lanes))
        for i in range(_SHIFTS)
    ]


def _pieces(text: Column) -> Column:
    """array<array<bigint>>: the hashes of the words of each piece; no piece spans two paragraphs."""
    words = F.regexp_extract_all(F.concat(text, F.lit("\n")), F.lit(_WORD), F.lit(0))
    last = F.lit(~CUT)
    hashes = F.transform(
        words, lambda w: F.when(w.endswith("\n"), F.xxhash64(w).bitwiseAND(last)).otherwise(F.xxhash64(w))
    )

    def cut(h: Column) -> Column:
        ends = F.filter(
            F.transform(h, lambda x, i: F.when(x.bitwiseAND(F.lit(CUT)) == 0, i + 1)), lambda i: i.isNotNull()
        )

        def runs(ends: Column) -> Column:
            def run(end: Column, i: Column) -> Column:
                before = F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
                return F.slice(h, before + 1, end - before)

            return F.transform(ends, run)

        return let(ends, runs)

    return let(hashes, cut)


def fingerprint(text: Column) -> Column:
    """array<bigint>: two wide sums, the number of pieces, 62 entries of two counters each.

    Empty paragraphs count, so that "" and "\\n" differ. Equal texts, and texts whose
    paragraphs are in another order, have equal fingerprints. A text's words are held in memory at once.
    """
    paragraphs = F.split(text, "\n", -1)
    pieces = F.transform(_pieces(text), lambda p: F.xxhash64(p))
    wide = let(
        paragraphs,
        lambda p: F.array(*[_total(_hashes(p, seed), lambda h: h.bitwiseAND(F.lit(_MODULUS))) for seed in (1, 2)]),
    )

    def packed(p: Column) -> Column:
        return F.concat(
            F.array(F.size(p).cast("bigint")),
            let(_hashes(p, 3), lambda h: F.array(*_bits(h))),
            let(_hashes(p, 4), lambda h: F.array(*_bits(h))),
        )

    return F.concat(wide, let(pieces, packed))


def combined(left: Column, right: Column, sign: int = 1) -> Column:
    """The fingerprint of both multisets together (sign 1), or of left without right (-1)."""
    return F.zip_with(
        left,
        right,
        lambda a, b: (a + b if sign > 0 else a - b + F.lit(1 << 62)).bitwiseAND(F.lit(_MODULUS)),
    )


def _signed(print_: Column) -> Column:
    """The counters as numbers around zero: twice the count less the number of pieces."""
    n = F.get(print_, F.lit(2))
    return F.flatten(
        F.transform(
            F.slice(print_, 4, 2 * _SHIFTS),
            lambda v: F.array(
                *[
                    2 * F.shiftrightunsigned(v, s).bitwiseAND(F.lit(_FIELD)) - n
                    for s in _OFFSETS
                ]
            ).cast("array<double>"),
        )
    )


def likeness(left: Column, right: Column) -> Column:
    """0 to 1: 1 for equal fingerprints, else the cosine of the counters, not below 0."""

    def cosine(a: Column, b: Column) -> Column:
        dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        norms = [
            F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x) for v in (a, b)
        ]
        scale = F.sqrt(norms[0] * norms[1])
        return F.when(scale > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot / scale))).otherwise(0.0)

    return F.when(left == right, F.lit(1.0)).otherwise(
        let(_signed(left), lambda a: let(_signed(right), lambda b: cosine(a, b)))
    )


def as_text(print_: Column) -> Column:
    """The fingerprint as hexadecimal digits."""
    return F.lower(F.array_join(F.transform(print_, lambda v: F.lpad(F.hex(v), 16, "0")), ""))


def successors(docs: DataFrame) -> DataFrame:
    """(doc, id_hash, version, next_*, user_*) for each distinct (doc, text) row: the row after it,
    the row before it, and what they need.

    Rows are ordered by id, then by a hash of their text (``version``); the first follows the
    last, a null id comes first. Only this slim table is sorted: dealt by ranges, it gets
    the next row inside its range by a window, and over the border from the first row of each
    range, of which there are as many as partitions.
    """
    slim = docs.select(
        "doc",
        F.xxhash64("doc").alias("id_hash"),
        F.xxhash64("text").alias("version"),
        F.floor(F.char_length("text") / 4).cast("int").alias("need"),
    ).distinct()
    ranged = saved(
        slim.repartitionByRange(F.col("doc").asc_nulls_first(), F.col("version").asc()).withColumn(
            "range", F.spark_partition_id()
        ),
        "ranges",
    )
    row = "struct(doc IS NOT NULL AS filled, doc, version, id_hash, need)"
    inside = "OVER (PARTITION BY range ORDER BY doc NULLS FIRST, version)"
    edges = ranged.groupBy("range").agg(F.expr(f"min({row})").alias("head"), F.expr(f"max({row})").alias("tail"))
    around = (
        "OVER (ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    )
    borders = edges.selectExpr(
        "range",
        f"coalesce(lead(head) OVER (ORDER BY range), first(head) {around}) AS after",
        f"coalesce(lag(tail) OVER (ORDER BY range), last(tail) {around}) AS before",
    )
    led = ranged.selectExpr("*", f"lead({row}) {inside} AS follower", f"lag({row}) {inside} AS user")
    return (
        led.join(F.broadcast(borders), "range")
        .withColumn("follower", F.coalesce("follower", "after"))
        .withColumn("user", F.coalesce("user", "before"))
        .select(
            "doc",
            "id_hash",
            "version",
            F.col("follower.id_hash").alias("next_id_hash"),
            F.col("follower.version").alias("next_version"),
            F.col("user.id_hash").alias("user_id_hash"),
            F.col("user.version").alias("user_version"),
            F.col("user.need").alias("user_need"),
        )
    )


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many
    (or all) of the next document by id. A null text is empty. Repeated rows give equal
    results, and the row after them is the next different one; rows with one id and several
    texts follow each other by a hash of the text. A single row is its own next row. An empty
    table gives an empty table.

    Each text is shuffled once, to learn how many of its first characters the row before it
    needs; only those are shuffled again, to the text that takes them.
    """
    row_key = ["id_hash", "version"]
    source = keyed_texts(docs, key, text).withColumns(
        {"id_hash": F.xxhash64("doc"), "version": F.xxhash64("text")}
    )
    order = saved(successors(source), "order")
    # Both uses of ``met`` read the same columns of ``source``, so they share its shuffle.
    source = source.drop("doc")
    met = source.join(order.hint("shuffle_hash"), row_key)
    heads = met.select(
        F.col("user_id_hash").alias("id_hash"),
        F.col("user_version").alias("version"),
        F.expr("left(text, user_need)").alias("head"),
    ).dropDuplicates(row_key)
    n = F.char_length("text").cast("bigint")
    edited = met.join(heads, row_key).select(
        "doc",
        *row_key,
        "next_id_hash",
        "next_version",
        n.alias("n_chars"),
        F.col("text"),
        F.expr("concat(left(text, cast(char_length(text) - floor(char_length(text) / 4) AS int)), head)").alias("edited"),
    )
    # A generator keeps each text expression from being computed once per use.
    prints = saved(
        edited.select(
            "doc",
            *row_key,
            "next_id_hash",
            "next_version",
            "n_chars",
            fingerprint(F.col("text")).alias("print"),
            F.inline(
                F.array(
                    let(
                        F.col("edited"),
                        lambda e: F.struct(
                            F.sha2(e, 256).alias("edited_sha256"), fingerprint(e).alias("edited_print")
                        ),
                    )
                )
            ),
        ),
        "prints",
    )
    following = prints.select(
        F.col("id_hash").alias("next_id_hash"), F.col("version").alias("next_version"), F.col("print").alias("next_print")
    ).dropDuplicates(["next_id_hash", "next_version"])
    return prints.join(following, ["next_id_hash", "next_version"]).select(
        F.col("doc").alias(key),
        "n_chars",
        "edited_sha256",
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
