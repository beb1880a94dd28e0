"""Annotation looks at runs of pieces, not at each piece, with the results of looking at each."""

import random

from pyspark.sql import functions as F

from corpusmill.functions.literals import one_of
from corpusmill.functions.text import let, pieces
from corpusmill.operators import entities as ent
from corpusmill.operators import lookups
from corpusmill.operators import sentiment as sent
from corpusmill.operators import topics as top
from corpusmill.operators.stopwords import ALL_STOP_WORDS

PARTS = [
    "New", "York", "Apple Inc", "the", "THE", "http", "https://x.y/z?a=1", "http://", "a@b.co", "the@foo.com", ".q@r.st", "@", " ", " ",
    "  ", "\t", "\n", " \n ", "　", ".", ",", "-", "%", "+", "_", "42", "3.5%", "$5", "$", "€3.50", "2024-01-02", "2024-01-02x", "é",
    "für", "FÜR", "İn", "ſo", "K", "½", "x½", "٣", "😀", "\x01", "́", "1.2.3.4.5.6.7.8.9.10.11.12", "a" * 70 + "@b.com",
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(n)] + ["", None]


def test_plain_runs_are_one_match(spark):
    matcher = ent.literal_matcher({"New York": "GPE", "Apple": "ORG"}, spark)
    text = "the mill, grinds barley and rye. " * 300 + "New York; " + "é plain words " * 300
    cut = frame(spark, [text]).select(matcher._cut(F.col("text"))).first()[0]
    assert "".join(cut) == text and len(cut) < 10
    assert ["New", " ", "York"] == [p for p in cut if p in ("New", "York") or p == " "]


def test_coarse_cut_finds_the_same(spark):
    gazetteer = {"New York": "GPE", "York": "Y", "Apple Inc": "ORG", ".": "DOT", "42": "N", "http://": "H", "é": "E", " \n ": "WS", "a@b.co 42": "X"}
    matcher = ent.literal_matcher(gazetteer, spark)
    t = F.col("text")
    rows = frame(spark, odd_texts(3000)).select(
        matcher.entities(t).alias("a"), F.when(t.isNotNull(), let(pieces(t), matcher._entities_in)).alias("b")
    ).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def test_runs_equal_those_by_piece(spark):
    t = F.col("text")
    by_piece = let(pieces(t), lambda c: F.filter(top.runs_by_piece(c, ALL_STOP_WORDS), lambda r: r.rlike(r"\p{L}")))
    df = frame(spark, odd_texts(3000)).select(top.candidate_phrases(t).alias("a"), by_piece.alias("b"))
    rows = df.collect()
    assert [r.a for r in rows] == [r.b for r in rows]
    assert any(len(r.a) > 2 for r in rows if r.a)


def test_one_of(spark):
    words = ["in", "the", "them", "für", "k"]
    texts = [("in",), ("IN",), ("THEM",), ("th",), ("FÜR",), ("K",), ("İn",), ("inn",)]
    df = spark.createDataFrame(texts, "t string").select("t", F.col("t").rlike(f"^{one_of(words, True)}$").alias("m"))
    assert [r.m for r in df.collect()] == [True, True, True, False, True, True, False, False]
    assert one_of([]) == ""


def test_places_of_rows_with_one_key(spark):
    """Rows may have one key and other texts; a null key meets nothing, as in a join."""
    gazetteer = {f"word{i} x": "W" for i in range(20)} | {"word1": "S"}
    docs = spark.createDataFrame([(1, "a word1 x"), (1, "word1 and word2 x"), (1, "a word1 x"), (None, "word1 x")], "id int, text string")
    prepared, matcher = ent.entity_matcher(docs, "text", gazetteer, "id", 1)
    found = prepared.select("text", matcher.entities(F.col("text")).alias("e")).collect()
    assert sorted((r.text, [(e.text, e.label, e.start) for e in r.e]) for r in found) == [
        ("a word1 x", [("word1 x", "W", 2)]), ("a word1 x", [("word1 x", "W", 2)]),
        ("word1 and word2 x", [("word1", "S", 0), ("word2 x", "W", 10)]), ("word1 x", []),
    ]


def test_joined_words_are_not_searched_in_the_row(spark):
    """What a joined vocabulary holds comes with its places; no expression looks them up in a map."""
    lexicon = {f"w{i}": i - 3.5 for i in range(30)}
    docs = frame(spark, ["w1 W2 none w1", "w29", "nothing", None])
    found = sent.lexicon_lookup(docs, "text", lexicon, "id", 1)
    scored = found[0].select("id", sent.lexicon_sentiment(F.col("text"), found[1]).alias("s"))
    assert "map" not in scored._jdf.queryExecution().optimizedPlan().toString().lower()
    plain = docs.select("id", sent.lexicon_sentiment(F.col("text"), lookups.LiteralLookup(lexicon)).alias("s"))
    assert sorted(scored.collect()) == sorted(plain.collect())
    prepared, matcher = ent.entity_matcher(docs, "text", {w: "W" for w in lexicon}, "id", 1)
    plan = prepared.select(matcher.entities(F.col("text")))._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_entries" not in plan and "array_contains" not in plan


def test_long_phrases_take_the_other_way(spark, monkeypatch):
    gazetteer = {f"w{i} and w{i + 1}": "W" for i in range(30)} | {"w3": "S", "long " * 6 + "w1": "L"}
    docs = frame(spark, ["w1 and w2 and w3", "long " * 6 + "w1", "", None, "w3"])
    found = []
    for most in (1, 50):
        monkeypatch.setattr(ent, "MAX_AHEAD", most)
        prepared, matcher = ent.entity_matcher(docs, "text", gazetteer, "id", 1)
        found.append(sorted(prepared.select("id", matcher.entities(F.col("text")).alias("e")).collect()))
    assert found[0] == found[1] and [len(r.e or []) for r in found[0]] == [2, 1, 0, 0, 1]
