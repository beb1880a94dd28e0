import math
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.config import AnnotationConfig, supported_annotation_types
from corpusmill.functions.instructions import instruction
from corpusmill.functions.text import distinct_ignoring_case, pieces, scan, sentences, tokens, tokens_of
from corpusmill.operators import entities as ent
from corpusmill.operators import keywords as kw
from corpusmill.operators import sentiment as sent
from corpusmill.operators import tagging
from corpusmill.operators.tagging import token_table
from corpusmill.operators.annotate import annotate, register_annotator, unregister_annotator
from corpusmill.operators.stopwords import ALL_STOP_WORDS

TEXTS = [
    "A ferry run by Apple Inc sails from Kiel at noon. On deck its founder Tim Cook sells tea.",
    "In the harbour office Satya Nadella of Microsoft counts the crates.",
    "What a wonderful morning on the water!",
    "The horrible rain came back, a worthless umbrella in hand.",
    "Could somebody explain the tide table to me?",
    "Tide tables list the hours of high water.",
]
IN_ROW = AnnotationConfig(enable_keywords=False)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def annotated(spark, texts, **options):
    rows = annotate(frame(spark, texts), "text", AnnotationConfig(), row_key="id", **options)
    return {r.id: r.text_annotations for r in rows.collect()}


def test_all_annotations(spark):
    found = annotated(spark, TEXTS)
    assert set(found[0].asDict()) == set(supported_annotation_types())
    names = [(e.text, e.label) for e in found[1].entities]
    assert ("Microsoft", "ORG") in names and ("Satya Nadella", "PERSON") in names
    assert found[2].sentiment.label == "positive" and found[3].sentiment.label == "negative"
    assert found[4].instruction.is_instruction and found[4].instruction.command_words == ["explain"]
    assert not found[5].instruction.is_instruction
    assert tuple(found[0].language) == ("en", 1.0)
    assert "ferry" in {k.text for k in found[0].keywords}


def test_blank_and_null_have_no_annotation(spark):
    found = annotated(spark, ["Boats leave at dawn.", "Gulls follow them.", "", "  \n", None])
    assert found[0] is not None and found[1] is not None
    assert found[2] is None and found[3] is None and found[4] is None


def test_disabled_annotations_are_absent(spark):
    config = AnnotationConfig(
        enable_entities=False, enable_topics=False, enable_keywords=False, enable_sentiment=False
    )
    row = annotate(frame(spark, TEXTS[:1]), "text", config).first()
    assert set(row.text_annotations.asDict()) == {"language", "instruction"}
    with pytest.raises(ValueError):
        annotate(frame(spark, TEXTS), "text", AnnotationConfig())


def test_own_annotators(spark):
    @F.pandas_udf("bigint")
    def characters(texts):
        return texts.str.len()

    register_annotator("n_chars", characters)
    try:
        row = annotate(frame(spark, ["abc def"]), "text", IN_ROW).first()
    finally:
        unregister_annotator("n_chars")
    assert row.text_annotations.n_chars == 7


def test_entity_offsets_and_overlaps(spark):
    text = "é New York City and New York, NEW york; mail a.b@c.org 5% or $3.50 on 2024-01-02 at 7am."
    gazetteer = {"New York": "GPE", "New York City": "GPE", "York": "X", "City and": "Y"}
    found = ent.entities(frame(spark, [text]), "text", gazetteer).collect()
    assert [(r.text, r.label) for r in found] == [
        ("New York City", "GPE"), ("New York", "GPE"), ("a.b@c.org", "EMAIL"), ("5%", "PERCENT"),
        ("$3.50", "MONEY"), ("2024-01-02", "DATE"),
    ]
    for r in found:
        assert text[r.start:r.end] == r.text


WORDS = st.sampled_from(["New", "York", "City", "Apple", "the", " ", " ", "  ", ".", "-", "42", "a@b.co", "é"])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(WORDS, max_size=25).map("".join), min_size=1, max_size=30))
def test_joined_gazetteer_equals_literal_gazetteer(spark, texts):
    """A gazetteer too large for the expression takes the join, with the same result."""
    gazetteer = {
        "New York": "GPE", "York City": "GPE", "Apple": "ORG", "New York City Apple": "LONG", ".": "DOT", "York.": "END",
        "a@b.co 42": "X", "New York City the Apple New": "SIX", "-the": "DASH",
    }
    table = spark.createDataFrame(sorted(gazetteer.items()), "phrase string, label string")
    docs = frame(spark, texts)
    results = []
    for limit in (100, 1):
        prepared, matcher = ent.entity_matcher(docs, "text", table, "id", limit)
        rows = prepared.select("id", matcher.entities(F.col("text")).alias("e")).collect()
        results.append({r.id: r.e for r in rows})
    assert results[0] == results[1]
    for i, text in enumerate(texts):
        for e in results[0][i]:
            assert text[e.start:e.end] == e.text


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aé. \n\t1,%$@-_😀x", max_size=60), min_size=1, max_size=30))
def test_pieces_lose_nothing(spark, texts):
    t = F.col("text")
    rows = frame(spark, texts).select(
        "text", pieces(t).alias("p"), tokens(t).alias("t"), tokens_of(pieces(t)).alias("u")
    ).collect()
    for r in rows:
        assert "".join(r.p) == r.text
        assert r.t == r.u == [p for p in r.p if p.strip()]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 16, 17, 100])
def test_scan_is_a_running_fold(spark, n):
    values = list(range(n))
    row = spark.createDataFrame([(values,)], "v array<int>").select(
        scan(F.col("v"), F.lit(5), lambda s, x: s + x, "int")
    ).first()[0]
    assert row == [5 + sum(values[: i + 1]) for i in range(n)]


def test_ordered_distinct_ignores_case(spark):
    row = spark.createDataFrame([(["b", "A", "B", "a", "c", "b"],)], "v array<string>")
    assert row.select(distinct_ignoring_case(F.col("v"))).first()[0] == ["b", "A", "c"]


def test_sentences(spark):
    row = frame(spark, ["One. Two!\nThree? four 3.5 five."]).select(sentences(F.col("text"))).first()[0]
    assert row == ["One.", "Two!", "Three?", "four 3.5 five."]


def test_instruction_patterns(spark):
    texts = ["Iffy start", "What? Then\nmore", "ends here?\n", "please: explain list", "statement"]
    rows = frame(spark, texts).select(instruction(F.col("text")).alias("i")).collect()
    assert [r.i.is_instruction for r in rows] == [True, False, True, True, False]
    assert rows[1].i.has_question_mark and rows[3].i.command_words == ["explain", "list"]


def test_sentiment_score_and_large_lexicon(spark):
    docs = frame(spark, ["good good bad", "nothing", None, "Bad"])
    lexicon = spark.createDataFrame([("good", 0.5), ("bad", -1.0), ("ugly", -1.0)], "word string, weight double")
    expected = {0: (0.0, "neutral"), 1: (0.0, "neutral"), 2: None, 3: (-1.0, "negative")}
    for limit in (100, 1):
        prepared, lookup = sent.lexicon_lookup(docs, "text", lexicon, "id", limit)
        rows = prepared.select("id", sent.lexicon_sentiment(F.col("text"), lookup).alias("s")).collect()
        assert {r.id: r.s and tuple(r.s) for r in rows} == expected


def test_trained_sentiment(spark):
    rows = [("lovely great day", 1.0), ("great food", 1.0), ("awful day", 0.0), ("awful bad food", 0.0)] * 5
    training = spark.createDataFrame(rows, "text string, y double")
    model = sent.train_sentiment(training, "text", "y", features=1024)
    found = sent.model_sentiment(frame(spark, ["great", "awful"]), model).orderBy("id").collect()
    assert [r.sentiment.label for r in found] == ["positive", "negative"]
    assert all(0.5 <= abs(r.sentiment.score) <= 1 for r in found)


def brute_force_keywords(texts, k):
    words = [[w for w in re.findall(r"\w+", t) if re.search(r"[^\W\d_]", w)] for t in texts]
    counts = Counter(w.lower() for ws in words for w in ws)
    total = sum(counts.values())
    result = {}
    for i, ws in enumerate(words):
        first = {}
        for at, w in enumerate(ws):
            if w.lower() not in ALL_STOP_WORDS:
                first.setdefault(w.lower(), (at, w))
        scored = [(-math.log(counts[w] / total), at, text) for w, (at, text) in first.items()]
        scored = sorted((s for s in scored if s[0] > 0.3), key=lambda s: (-s[0], s[1]))[:k]
        result[i] = [(text, round(score, 9)) for score, _, text in scored]
    return result


@pytest.mark.parametrize("hot_share", [1e-5, 0.05, 0.9])
def test_keywords_equal_brute_force(spark, monkeypatch, hot_share):
    """Whether words are broadcast as frequent or joined as rare does not matter."""
    monkeypatch.setattr(kw, "HOT_SHARE", hot_share)
    texts = ["Red fish, blue Fish red", "one fish two fish the fish", "Blue blue 42 x1 sky", "the of and", "sky"]
    found = {i: [] for i in range(len(texts))}
    for r in kw.keywords(frame(spark, texts), "text", "id", max_keywords=3).orderBy("id", "rank").collect():
        found[r.id].append((r.text, round(r.score, 9)))
    assert found == brute_force_keywords(texts, 3)


def test_tags_join_or_literal(spark):
    docs = frame(spark, ["Good news for him", None])
    tags = spark.createDataFrame([("good", "ADJ"), ("news", "NOUN"), ("x", "ADJ")], "word string, pos string")
    for limit in (100, 1):
        prepared, lookup = tagging.tag_lookup(docs, "text", tags, "id", limit)
        rows = prepared.orderBy("id").select(tagging.tagged(tokens(F.col("text")), lookup).alias("p")).collect()
        assert [tuple(p) for p in rows[0].p] == [("Good", "ADJ"), ("news", "NOUN"), ("for", "X"), ("him", "X")]
    only = kw.keywords(docs, "text", "id", tags=tags).collect()
    assert {(r.text, r.pos) for r in only} == {("Good", "ADJ"), ("news", "NOUN")}


def test_annotation_by_sentence(spark):
    matcher = ent.literal_matcher(ent.DEFAULT_GAZETTEER, spark)
    lookup = tagging.LiteralLookup(tagging.DEFAULT_TAGS)
    docs = frame(spark, [TEXTS[0], None])
    rows = docs.select(tagging.sentence_annotations(F.col("text"), matcher, lookup).alias("a")).collect()
    assert [[e.text for e in a.entities] for a in rows[0].a] == [["Apple Inc"], ["Tim Cook"]]
    assert all(a.sentiment == 0.0 and len(a.tokens) == len(a.pos_tags) for a in rows[0].a)
    assert rows[1].a is None


def test_given_counts_with_tags_keep_unseen_words(spark):
    from corpusmill.operators.keywords import UNSEEN_COUNT, keywords

    df = spark.createDataFrame([(1, "the walrus saw a zebra"), (2, "a walrus ran")], "id bigint, text string")
    counts = spark.createDataFrame([("walrus", 4), ("saw", 10), ("ran", 10)], "word string, n bigint")
    pairs = {"walrus": "NOUN", "zebra": "NOUN", "saw": "VERB"}
    frame = spark.createDataFrame(list(pairs.items()), "word string, pos string")
    for tags in (pairs, frame):
        rows = keywords(df, "text", "id", counts=counts, tags=tags).collect()
        found = {(r["id"], r["text"]): r["score"] for r in rows}
        assert set(found) == {(1, "walrus"), (1, "zebra"), (2, "walrus")}
        assert abs(found[1, "zebra"] + math.log(UNSEEN_COUNT / 24)) < 1e-9


def test_token_offsets_cut_the_text(spark):
    texts = ["One  two, \t3.5% é\U0001f600x a@b.co\n", "", None, "   ", "https://x.y/z? end"]
    found = {i: [] for i in range(len(texts))}
    for r in token_table(frame(spark, texts), "text").orderBy("id", "position").collect():
        assert texts[r.id][r.start:r.end] == r.token and r.position == len(found[r.id])
        found[r.id].append(r.token)
    expected = frame(spark, texts).select("id", tokens(F.col("text")).alias("t")).collect()
    assert found == {r.id: r.t or [] for r in expected}


@pytest.mark.parametrize("hot_share", [1e-5, 0.1, 2.0])
def test_topic_scores_by_hand(spark, monkeypatch, hot_share):
    """Degree over frequency over the corpus; broadcast and joined words score alike."""
    from corpusmill.operators import topics

    monkeypatch.setattr(topics, "HOT_SHARE", hot_share)
    docs = frame(spark, ["Linear systems and linear equations. Linear Systems", "the systems", None, "the of"])
    # Phrases: linear systems (twice), linear equations, systems.
    linear, systems, equations = (2 + 2 + 2) / 3, (2 + 2 + 1) / 3, 2 / 1
    rows = topics.ranked_topics(docs, "text", "id").orderBy("id", "position").collect()
    assert [(r.id, r.position, r.topic, r["rank"], r.score) for r in rows] == [
        (0, 0, "Linear systems", 2, pytest.approx(linear + systems, abs=3e-6)),
        (0, 1, "linear equations", 1, pytest.approx(linear + equations, abs=3e-6)),
        (1, 0, "systems", 1, pytest.approx(systems, abs=3e-6)),
    ]
    few = topics.ranked_topics(docs, "text", "id", most=1).collect()
    assert sorted(r.topic for r in few) == ["linear equations", "systems"]
