"""Named entities: gazetteer phrases and things recognisable by their shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.literals import one_of
from ..functions.text import let, named, pieces, scan, starts_digit, starts_letter
from ..session import written
from .bloom import BloomFilter
from .lookups import MAX_LITERAL_ENTRIES, LiteralLookup, RowLookup, attach_places, text_hash

# Phrases known without a gazetteer of the user's.
DEFAULT_GAZETTEER = {
    "Apple": "ORG",
    "Apple Inc": "ORG",
    "Google": "ORG",
    "Microsoft": "ORG",
    "Satya Nadella": "PERSON",
    "Tim Cook": "PERSON",
    "AFRICA": "GPE",
    "AMERICA": "GPE",
    "ASIA": "GPE",
    "EUROPE": "GPE",
    "MIDDLE EAST": "GPE",
}
# Helper columns of a joined gazetteer.
HELPERS = ("_places", "_phrases", "_firsts")
# Phrases of up to so many pieces get their runs from columns beside each piece.
MAX_AHEAD = 8

_HIT = "struct<at:int,span:int,label:string>"
_ENTITY = "array<struct<text:string,label:string,start:int,end:int>>"


class EntityMatcher:
    """Finds entities in a text column by expressions on its pieces.

    A phrase matches where it begins and ends at piece borders. Of the matches at
    one place the longest counts, and a match inside an earlier one does not.
    """

    def __init__(self, lookup, first_pieces: list[str], spans: list[int], row_firsts: Column | None = None):
        self._lookup = lookup
        self._first_pieces = first_pieces
        self._spans = spans
        self._row_firsts = row_firsts

    def for_parts(self) -> "EntityMatcher":
        """For any text made of the prepared column, such as its sentences."""
        return self

    def _starts_phrase(self, piece: Column) -> Column:
        if self._row_firsts is not None:
            return F.coalesce(F.array_contains(self._row_firsts, piece), F.lit(False))
        return piece.isin(*self._first_pieces) if self._first_pieces else F.lit(False)

    def _cut(self, text: Column) -> Column:
        """The pieces of a text, but runs in which no entity begins are one: most of the text, which
        no expression then looks at piece by piece."""
        if self._row_firsts is not None:
            return pieces(text)
        firsts = one_of(self._first_pieces)
        most = max(self._spans, default=1)

        def cut(with_email: bool) -> Column:
            return F.regexp_extract_all(text, F.lit(P.coarse_piece(firsts, most, with_email)), F.lit(0))

        matches = F.when(text.contains("@"), cut(True)).otherwise(cut(False))
        if most == 1:
            return matches
        opens = f"^{firsts}"
        return F.flatten(F.transform(matches, lambda m: F.when(m.rlike(opens), pieces(m)).otherwise(F.array(m))))

    def _phrase_at(self, cut: Column, at: Column) -> Column:
        """The longest phrase that starts at piece ``at``, as a hit, or null."""
        spans = F.array(*[F.lit(n) for n in self._spans])
        fitting = F.filter(spans, lambda n: at + n <= F.size(cut))
        tried = F.transform(
            fitting,
            lambda n: F.struct(
                n.alias("span"),
                let(
                    F.array_join(F.slice(cut, at + 1, n), ""), self._lookup.value
                ).alias("label"),
            ),
        )
        return let(
            F.get(F.filter(tried, lambda c: c["label"].isNotNull()), F.lit(0)),
            lambda best: F.when(
                best.isNotNull(),
                F.struct(
                    at.cast("int").alias("at"),
                    best["span"].cast("int").alias("span"),
                    best["label"].cast("string").alias("label"),
                ),
            ),
        )

    @staticmethod
    def _shape_of(piece: Column) -> Column:
        """The label by shape or null. Plain words and single characters, which most
        pieces are, are told by comparisons alone."""
        label = F.lit(None).cast("string")
        for name, pattern in reversed(P.ENTITY_SHAPES):
            label = F.when(piece.rlike(pattern), name).otherwise(label)
        address = F.when(
            piece.startswith("http") & piece.rlike(dict(P.ENTITY_SHAPES)["URL"]), "URL"
        ).when(piece.contains("@"), "EMAIL")
        digit = starts_digit(piece) | ((piece >= "\x80") & piece.rlike(r"^\p{Nd}"))
        return (
            F.when(starts_letter(piece), address)
            .when(F.length(piece) == 1, F.when(digit, "NUMBER"))
            .otherwise(F.when(piece.rlike(P.ENTITY_HINT), label))
        )

    def _hits(self, cut: Column) -> Column:
        """At most one hit per piece, in text order, overlaps not yet resolved."""

        def shaped(piece: Column, at: Column) -> Column:
            return let(
                self._shape_of(piece),
                lambda label: F.when(
                    label.isNotNull(),
                    F.struct(
                        at.cast("int").alias("at"),
                        F.lit(1).alias("span"),
                        label.alias("label"),
                    ),
                ),
            )

        def hit(piece: Column, at: Column) -> Column:
            phrase = F.when(self._starts_phrase(piece), self._phrase_at(cut, at))
            return F.coalesce(phrase, shaped(piece, at))

        return F.array_compact(F.transform(cut, hit)).cast(f"array<{_HIT}>")

    @staticmethod
    def _without_overlaps(hits: Column) -> Column:
        def resolve(found: Column) -> Column:
            ends = scan(
                found,
                F.lit(0),
                lambda end, h: F.when(h["at"] >= end, h["at"] + h["span"]).otherwise(end),
                "int",
            )
            # A hit that was taken moved the end; the others left it in place.
            return let(
                ends,
                lambda e: F.filter(
                    found,
                    lambda h, i: h["at"]
                    >= F.when(i == 0, F.lit(0)).otherwise(F.get(e, i - 1)),
                ),
            )

        # Hits of one piece each cannot overlap.
        return let(
            hits,
            lambda found: F.when(
                F.exists(found, lambda h: h["span"] > 1), resolve(found)
            ).otherwise(found),
        )

    def has_entity(self, text: Column) -> Column:
        """Whether there is any; looks no further than the first."""

        def some(cut: Column) -> Column:
            by_shape = F.exists(cut, lambda p: self._shape_of(p).isNotNull())
            starts = F.exists(cut, self._starts_phrase)
            return F.coalesce(
                by_shape | (starts & (F.size(self._hits(cut)) > 0)), F.lit(False)
            )

        return let(self._cut(text), some)

    def entities(self, text: Column) -> Column:
        """Array of (text, label, start, end); offsets count code points, end exclusive."""
        return F.when(text.isNotNull(), let(self._cut(text), self._entities_in))

    def _entities_in(self, cut: Column) -> Column:

        def joined(start: Column, count: Column) -> Column:
            return F.array_join(F.slice(cut, start + 1, count), "")

        def placed(parts: Column) -> Column:
            """Offsets are running totals of what lies between and in the hits."""
            ends = scan(
                parts, F.lit(0), lambda end, p: end + p["gap"] + F.length(p["text"]), "int"
            )
            return F.zip_with(
                parts,
                ends,
                lambda p, end: F.struct(
                    p["text"].alias("text"), p["label"].alias("label"),
                    (end - F.length(p["text"])).alias("start"), end.alias("end"),
                ),
            ).cast(_ENTITY)

        def located(hits: Column) -> Column:
            def part(hit: Column, i: Column) -> Column:
                last = F.get(hits, i - 1)
                free = F.when(i == 0, F.lit(0)).otherwise(last["at"] + last["span"])
                return F.struct(
                    joined(hit["at"], hit["span"]).alias("text"),
                    hit["label"].alias("label"),
                    F.length(joined(free, hit["at"] - free)).alias("gap"),
                )

            return let(F.transform(hits, part), placed)

        def found(hits: Column) -> Column:
            return F.when(
                F.size(hits) > 0, let(self._without_overlaps(hits), located)
            ).otherwise(F.array().cast(_ENTITY))

        return let(self._hits(cut), found)


def literal_matcher(gazetteer: dict, spark) -> EntityMatcher:
    """A matcher for a gazetteer small enough to be part of the expression."""
    gazetteer = {p: l for p, l in gazetteer.items() if p}
    if not gazetteer:
        return EntityMatcher(LiteralLookup({}), [], [])
    # Spark cuts the phrases, so that they end where the pieces of a text end.
    phrases = F.array(*[F.lit(p) for p in sorted(gazetteer)])
    cuts = spark.range(1).select(F.transform(phrases, pieces)).first()[0]
    spans = sorted({len(cut) for cut in cuts}, reverse=True)
    return EntityMatcher(LiteralLookup(gazetteer), sorted({cut[0] for cut in cuts}), spans)


class PlacedMatcher(EntityMatcher):
    """For a prepared text column whose phrases were found by a join: the row's ``_places`` has (at,
    span, value) of each, sorted by ``at``. No piece is searched for among the row's phrases."""

    def __init__(self, places: Column, by_row: EntityMatcher):
        super().__init__(None, [], [])
        self._places = places
        self._by_row = by_row

    def for_parts(self) -> EntityMatcher:
        return self._by_row

    def _cut(self, text: Column) -> Column:
        return pieces(text)

    def _hits(self, cut: Column) -> Column:
        def hit(at: Column, by_shape: int, span: Column, label: Column) -> Column:
            return F.struct(
                at.cast("int").alias("at"), F.lit(by_shape).alias("by_shape"), (-span).cast("int").alias("shorter"),
                label.cast("string").alias("label"),
            )

        none = F.array().cast("array<struct<at:int,by_shape:int,shorter:int,label:string>>")
        phrases = F.transform(
            F.filter(self._places, lambda p: p["value"].isNotNull()), lambda p: hit(p["at"], 0, p["span"], p["value"])
        )
        shapes = F.filter(
            F.transform(cut, lambda p, at: hit(at, 1, F.lit(1), self._shape_of(p))), lambda h: h["label"].isNotNull()
        )
        # At one place a phrase comes before a shape, and the longest first.
        ranked = F.sort_array(F.concat(F.coalesce(phrases, none), F.coalesce(shapes, none)))
        firsts = let(
            ranked, lambda r: F.filter(r, lambda h, i: (i == 0) | (F.get(r, i - 1)["at"] != h["at"]))
        )
        return F.transform(
            firsts, lambda h: F.struct(h["at"].alias("at"), (-h["shorter"]).alias("span"), h["label"].alias("label"))
        ).cast(f"array<{_HIT}>")

    def has_entity(self, text: Column) -> Column:
        by_shape = let(pieces(text), lambda cut: F.exists(cut, lambda p: self._shape_of(p).isNotNull()))
        phrase = F.exists(self._places, lambda p: p["value"].isNotNull())
        return F.when(text.isNotNull(), F.coalesce(phrase, F.lit(False)) | by_shape).otherwise(F.lit(False))


def phrase_probes(df: DataFrame, row_key: str, text: Column, phrases: DataFrame, spans: list[int]) -> DataFrame:
    """(_row, _text, _at, _span, _entry): the runs of pieces that may be one of ``phrases`` (phrase), by the
    place of their first piece. ``_text`` is a hash of the text.

    A piece that opens no phrase is dropped by a Bloom filter of the first pieces, before any run
    that starts with it is built. From the others on there is a run of as many pieces as some
    phrase has, for each number.
    """
    firsts = phrases.where(F.col("phrase") != "").select(F.get(pieces(F.col("phrase")), F.lit(0)).alias("first")).distinct()
    opens = BloomFilter.of(firsts, "first").might_hold(F.col("piece"))
    most = max(spans)
    row = [named(row_key).alias("_row"), text_hash(text).alias("_text")]
    if most <= MAX_AHEAD:
        # The pieces beside those that follow them, by whole arrays and not for each piece.
        names = ["piece"] + [f"p{k}" for k in range(1, most)]
        kind = "array<struct<" + ",".join(f"{n}:string" for n in names) + ">>"
        places = let(
            pieces(text),
            lambda cut: F.arrays_zip(*[F.slice(cut, k + 1, F.size(cut)) for k in range(most)]),
        ).cast(kind)
        runs = F.array(*[F.struct(F.lit(n).alias("_span"), F.concat(*names[:n]).alias("_entry")) for n in spans])
        runs = F.filter(runs, lambda r: r["_entry"].isNotNull())
    else:
        kind = "array<struct<piece:string,ahead:array<string>>>"
        places = let(
            pieces(text),
            lambda cut: F.transform(
                cut, lambda p, i: F.struct(p.alias("piece"), F.slice(cut, i + 1, F.lit(most)).alias("ahead"))
            ),
        )
        runs = F.transform(
            F.filter(F.array(*[F.lit(n) for n in spans]), lambda n: n <= F.size("ahead")),
            lambda n: F.struct(n.alias("_span"), F.array_join(F.slice("ahead", F.lit(1), n), "").alias("_entry")),
        )
    # Not the bare column: Spark would infer a filter on it and compute it twice.
    listed = F.coalesce(places, F.array().cast(kind))
    return (
        df.select(*row, F.posexplode(listed).alias("_at", "_place"))
        .select("_row", "_text", "_at", "_place.*")
        .where(opens)
        .select("_row", "_text", "_at", F.inline(runs))
    )


def entity_matcher(
    df: DataFrame,
    text_col: str,
    gazetteer=None,
    row_key: str | None = None,
    limit: int = MAX_LITERAL_ENTRIES,
) -> tuple[DataFrame, EntityMatcher]:
    """Prepare ``df`` for matching and return it with its matcher.

    ``gazetteer`` is a dict or a DataFrame (phrase, label). One of more than
    ``limit`` phrases is joined, for which ``row_key`` must name a unique column;
    the returned frame then carries the columns ``HELPERS``, and its matcher serves the texts of
    ``text_col``, its ``for_parts()`` others made of them. Both ways find the same: phrases of any shape and of as many pieces as the table has.
    """
    spark = df.sparkSession
    if gazetteer is None:
        gazetteer = DEFAULT_GAZETTEER
    if isinstance(gazetteer, dict):
        if len(gazetteer) <= limit:
            return df, literal_matcher(gazetteer, spark)
        gazetteer = spark.createDataFrame(
            sorted(gazetteer.items()), "phrase string, label string"
        )
    rows = (
        gazetteer.groupBy("phrase").agg(F.min("label").alias("label")).limit(limit + 1).collect()
    )
    if len(rows) <= limit:
        return df, literal_matcher({r.phrase: r.label for r in rows}, spark)
    if row_key is None:
        raise ValueError(f"a gazetteer of more than {limit} phrases needs row_key")
    # Read several times from here on.
    gazetteer = written(gazetteer.groupBy("phrase").agg(F.min("label").alias("label")), "gazetteer")
    # One row for each length that occurs.
    lengths = gazetteer.where(F.col("phrase") != "").select(F.size(pieces(F.col("phrase"))).alias("n")).distinct()
    spans = sorted((r.n for r in lengths.collect()), reverse=True)
    if not spans:
        return df, literal_matcher({}, spark)
    probes = phrase_probes(df, row_key, named(text_col), gazetteer, spans)
    matched = attach_places(df, row_key, text_col, probes, gazetteer, "phrase", "label", "_places", "_phrases")
    firsts = F.array_distinct(
        F.transform(F.map_keys("_phrases"), lambda p: F.get(pieces(p), F.lit(0)))
    )
    by_row = EntityMatcher(RowLookup(F.col("_phrases")), [], spans, F.col("_firsts"))
    return matched.withColumn("_firsts", firsts), PlacedMatcher(F.col("_places"), by_row)


def entities(df: DataFrame, text_col: str, gazetteer=None, row_key: str | None = None) -> DataFrame:
    """One row per entity: the columns of ``df`` but the text, then the entity's."""
    others = [c for c in df.columns if c != text_col]
    prepared, matcher = entity_matcher(df, text_col, gazetteer, row_key)
    return prepared.select(
        *[named(c) for c in others], F.inline(matcher.entities(named(text_col)))
    )
