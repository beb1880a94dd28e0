"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders. Windows of the template are hashed, and
those of the documents joined with those of the benchmark items, so that a question that was
asked again with other numbers or names still meets its item. Along each alignment the slots are
then checked: one filler of the item must always stand for one filler of the document.

A capitalised word at the beginning of a sentence may be a name or not, so there are two templates of
each text, one in which it stays a word and one in which it is a name.

Beside the templates, windows of the words and numbers themselves, in lower case, find what recurs
literally: copies in another letter case, items that are mostly numbers, and copies with a few
fillers altered, whatever their other slots say.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, named
from ..operators.bloom import BloomFilter
from .common import keyed_texts, saved

WINDOW = 8
SHORTEST = 4
MIN_SHARE = 0.25
MAX_BROADCAST_WINDOWS = 1_000_000
# Units that make a slot after a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr ms "
    "metres meters kilometres kilometers miles feet inches grams kilograms pounds ounces litres liters "
    "seconds minutes hours days weeks months years percent degrees dollars euros cents"
).split()
_NAME, _UNIT = "\x01", "\x02"
_NUMBER_SLOT, _NAME_SLOT, _UNIT_SLOT = "#n", "#p", "#u"
# Each begins with what most characters are not, so that most places cost one comparison.
_MARKS = [
    (r"(\p{Lu})(?<=[\p{L}\d,;] .)(\p{Ll}++)(?![\p{L}\d])", _NAME + "$1$2"),
    (r"(\d ?)(" + "|".join(UNITS) + r")(?![\p{L}\d])", "$1" + _UNIT + "$2"),
]
_TOKEN = (
    _NAME + r"\p{Lu}\p{Ll}+(?: " + _NAME + r"\p{Lu}\p{Ll}+)*+"
    r"|" + _UNIT + r"?\p{L}++"
    r"|\d++(?:[.,:]\d++)*+"
)
_LITERAL = r"\p{L}++|\d++(?:[.,:]\d++)*+"


def tokens(text: Column) -> Column:
    """Words, numbers, and runs of names as one token; names and units carry a mark.

    A name is a capitalised word after a letter, a digit, a comma or a semicolon and a blank; a unit is
    one of ``UNITS`` after a number.
    """
    for pattern, mark in _MARKS:
        text = F.regexp_replace(text, pattern, mark)
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def _initial(token: Column) -> Column:
    """A capitalised word without a mark. Comparisons spare most words the regular expression."""
    return (token >= "A") & ((token < "[") | (token >= "\x80")) & token.rlike(r"^\p{Lu}\p{Ll}+$")


def canonical(token: Column, initials: Column | bool = False) -> Column:
    """The word in lower case, or the placeholder of a slot. With ``initials`` a capitalised word
    without a mark, as at the beginning of a sentence, is a name as well."""
    plain = (
        F.when(token >= "A", F.lower(token))
        .when(token >= "0", F.lit(_NUMBER_SLOT))
        .when(token.startswith(_NAME), F.lit(_NAME_SLOT))
        .otherwise(F.lit(_UNIT_SLOT))
    )
    if initials is False:
        return plain
    return F.when(F.lit(initials) & _initial(token), _NAME_SLOT).otherwise(plain)


def _token_hashes(template: Column) -> Column:
    return F.transform(template, lambda t: F.xxhash64(t))


def window_hashes(hashes: Column, size: int, initials: bool = False) -> Column:
    """array<bigint>: a hash of each window of ``size`` tokens of a template, of which ``hashes`` has that of each
    token. Those of the two kinds of templates differ, so that one number is the whole key of a join."""
    kind = [F.lit(1)] if initials else []

    def of_hashes(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - size)
        return F.when(
            F.size(hashes) >= size,
            F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)], *kind)),
        ).otherwise(F.array().cast("array<bigint>"))

    return let(hashes, of_hashes)


def _template(text: Column, initials: bool) -> Column:
    return F.transform(tokens(text), lambda t: canonical(t, initials))


def _literal(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_LITERAL), F.lit(0))


def _cut(text: Column, exact: bool, initials: bool) -> Column:
    return _literal(text) if exact else _template(text, initials)


def benchmark_windows(items: DataFrame, item: str, text: str, initials: bool = False) -> DataFrame:
    """(item, item_version, exact, size, n_windows, item_at, h, slotted): the windows of each item, of its literal
    words and numbers (exact) and of its template; with ``initials`` only of the template in which
    capitalised words at the beginning of a sentence are names too. Windows of the template that are mostly slots say too
    little; they are left out and not counted in n_windows.

    An item of fewer than ``WINDOW`` tokens is one window of its own size; one of fewer than
    ``SHORTEST`` says too little and has none.
    """
    cut = items.select(named(item).alias("item"), F.coalesce(named(text).cast("string"), F.lit("")).alias("text")).distinct()
    parts = []
    for exact in (False,) if initials else (False, True):
        part = cut.select(
            "item", F.xxhash64("text").alias("item_version"), F.lit(exact).alias("exact"),
            _cut(F.col("text"), exact, initials).alias("template"),
        )
        part = (
            part.withColumn("size", F.least(F.size("template"), F.lit(WINDOW)))
            .where(F.col("size") >= SHORTEST)
            .withColumn("token_hashes", _token_hashes(F.col("template")))
        )
        hashes = F.lit(None).cast("array<bigint>")
        for size in range(SHORTEST, WINDOW + 1):
            hashes = F.when(F.col("size") == size, window_hashes(F.col("token_hashes"), size, initials)).otherwise(hashes)

        def slots(at: Column) -> Column:
            return F.size(F.filter(F.slice("template", at + 1, F.col("size")), lambda t: t.startswith("#")))

        starts = F.filter(
            F.sequence(F.lit(0), F.size("template") - F.col("size")), lambda i: 2 * slots(i) <= F.col("size")
        )
        parts.append(
            part.withColumns({"hashes": hashes, "starts": starts})
            .select("*", F.explode("starts").alias("item_at"))
            .select(
                "item",
                "item_version",
                "exact",
                "size",
                F.size("starts").alias("n_windows"),
                "item_at",
                F.get("hashes", "item_at").alias("h"),
                (slots(F.col("item_at")) > 0).alias("slotted"),
            )
        )
    return reduce(DataFrame.union, parts)


def _document_windows(text: Column, exact: bool, size: int) -> Column:
    """array<bigint>: the window hashes of a text; of its two templates, from one cut, one after the other."""
    if exact:
        return window_hashes(_token_hashes(_literal(text)), size)

    def of_both(cut: Column) -> Column:
        def windows(plain: Column) -> Column:
            name = F.xxhash64(F.lit(_NAME_SLOT))
            other = F.zip_with(cut, plain, lambda t, h: F.when(_initial(t), name).otherwise(h))
            return F.concat(window_hashes(plain, size), window_hashes(other, size, True))

        return let(F.transform(cut, lambda t: F.xxhash64(canonical(t))), windows)

    return let(tokens(text), of_both)


def _consistent(item_tokens: Column, doc_tokens: Column, places: Column, shift: Column, initials: Column) -> Column:
    """At the item's slots among ``places``, one filler of the item stands for one of the document."""
    slots = F.filter(places, lambda i: canonical(F.get(item_tokens, i), initials).startswith("#"))
    pairs = F.transform(
        slots,
        lambda i: F.struct(F.get(item_tokens, i).alias("of"), F.get(doc_tokens, i + shift).alias("by")),
    )
    return let(
        F.array_distinct(pairs),
        lambda d: F.struct(
            (F.size(F.array_distinct(F.transform(d, lambda p: p["of"]))) == F.size(d)).alias("holds"),
            F.exists(d, lambda p: p["of"] != p["by"]).alias("changed"),
        ),
    )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """(key, item, n_windows, n_shared, changed, id_hash, version): documents that hold an item.

    A row for each document and item where, on one alignment, at least ``min_share`` of the
    item's ``n_windows`` windows recur, either literally (but for letter case) or in the template with
    consistent slots; ``changed`` tells that some slot of the windows that recur has another filler. Null and empty texts hold nothing; repeated rows give one row; an empty
    table on either side gives an empty table. Null ids take part.

    Documents go to windows in a narrow pass; the windows of the items are broadcast while
    they are at most ``MAX_BROADCAST_WINDOWS`` (counted), and joined by shuffle beyond.
    """
    source = keyed_texts(docs, key, text).withColumns(
        {"id_hash": F.xxhash64("doc"), "version": F.xxhash64("text")}
    )
    kinds = [
        benchmark_windows(items, item, item_text, initials).withColumn("initials", F.lit(initials)) for initials in (False, True)
    ]
    index = saved(kinds[0].union(kinds[1]), "benchmark-windows")
    sizes = [tuple(r) for r in index.select("exact", "size").distinct().collect()]  # 2 * WINDOW at most
    small = index.count() <= MAX_BROADCAST_WINDOWS
    found = None
    for exact, size in sizes or [(False, WINDOW)]:
        of_size = index.where((F.col("size") == size) & (F.col("exact") == exact))
        # Places go on from the first template to the second: on one alignment all are shifted alike.
        part = (
            source.select("doc", "id_hash", "version", F.posexplode(_document_windows(F.col("text"), exact, size)).alias("at", "h"))
            .join(F.broadcast(of_size) if small else of_size, "h")
        )
        found = part if found is None else found.union(part)
    aligned = saved(
        found.groupBy(
            "id_hash", "version", "item", "item_version", "exact", "initials", "size", "n_windows",
            (F.col("at") - F.col("item_at")).alias("shift"),
        )
        .agg(
            F.first("doc").alias("doc"),
            F.collect_set("item_at").alias("starts"),
            F.max("slotted").alias("slotted"),
        )
        .withColumn("n_shared", F.size("starts"))
        .where(F.col("n_shared") >= F.lit(min_share) * F.col("n_windows")),
        "alignments",
    )
    plain = aligned.where(~F.col("slotted")).withColumn("changed", F.lit(False))
    item_texts = items.select(F.coalesce(named(item_text).cast("string"), F.lit("")).alias("item_text")).distinct()
    cut_items = item_texts.select(
        F.xxhash64("item_text").alias("item_version"), tokens(F.col("item_text")).alias("item_tokens")
    )
    # Only the texts with such an alignment go on; a Bloom filter keeps the others out of the shuffle. Repeated
    # rows meet again in the last grouping.
    row = F.xxhash64("id_hash", "version")
    needed = BloomFilter.of(aligned.where("slotted").select(row.alias("row")), "row")
    cut_docs = source.select("id_hash", "version", "text").where(needed.might_hold(row))
    places = F.array_distinct(
        F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.col("size") - 1)))
    )
    checked = (
        cut_docs.join(aligned.where("slotted"), ["id_hash", "version"])
        .withColumn("doc_tokens", tokens(F.col("text")))
        .join(cut_items, "item_version")
        .withColumn("places", places)
        .withColumn(
            "shift", F.col("shift") - F.when(F.col("initials"), F.size("doc_tokens") - F.col("size") + 1).otherwise(0)
        )
        .withColumn("slots", _consistent(*[F.col(c) for c in ("item_tokens", "doc_tokens", "places", "shift", "initials")]))
        .where("slots.holds")
        .withColumn("changed", F.col("slots.changed"))
    )
    fields = ["id_hash", "version", "doc", "item", "n_windows", "n_shared", "changed"]
    return (
        plain.select(*fields)
        .union(checked.select(*fields))
        .groupBy("id_hash", "version", "item")
        .agg(
            F.first("doc").alias(key),
            F.max(F.struct("n_shared", "n_windows", "changed")).alias("best"),
        )
        .select(
            key,
            F.col("item").alias(item),
            F.col("best.n_windows").cast("bigint").alias("n_windows"),
            F.col("best.n_shared").cast("bigint").alias("n_shared"),
            F.col("best.changed").alias("changed"),
            "id_hash",
            "version",
        )
    )
