"""Ranked topics keep phrases in their texts' rows, and give what a plain count gives."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusmill import session
from corpusmill.operators import topics as top

PARTS = ["tide", "Tide", "TIDE", "tables", "für", "FÜR", "42", "x1", "http://a-b.c/", "http://a.b-c/", "HTTP://A-b.c/", "a@b.co", "été", "ΑΣ", "İn"]
BETWEEN = [" ", " ", "  ", " the ", ", ", ". ", "\n", " and ", "-", " "]


def odd_rows(n, seed=5):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(PARTS) + rng.choice(BETWEEN) for _ in range(rng.randint(0, 12))) for _ in range(n)]
    # Keys that come twice, with the same text and with another one, and rows without a key.
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (1, texts[2]), (n, None), (n + 1, "")]
    return rows + [(None, texts[3]), (None, texts[4])]


def plain(rows_of_phrases):
    """{row: {(topic, score)}} with places and ranks, by loops."""
    cut = lambda p: re.findall(r"[\w\u0300-\u036f]+", p)
    n, degree = Counter(), Counter()
    by_row = defaultdict(dict)
    for row, phrases in rows_of_phrases:
        for at, (topic, folded) in enumerate(phrases):
            for w in cut(folded):
                n[w] += 1
                degree[w] += len(cut(folded))
            by_row[row][folded] = min((at, topic), by_row[row].get(folded, (at, topic)))
    found = {}
    for row, firsts in by_row.items():
        score = {f: sum(degree[w] * 1_000_000 // n[w] for w in cut(f)) / 1_000_000 for f in firsts}
        places = sorted(firsts, key=lambda f: firsts[f])
        ranks = sorted(places, key=lambda f: -score[f])
        found[row] = {(places.index(f), firsts[f][1], ranks.index(f) + 1, score[f]) for f in firsts}
    return found


@pytest.mark.parametrize("hot_share", [1e-6, 0.05, 2.0])
def test_ranks_as_plainly_counted(spark, monkeypatch, hot_share):
    monkeypatch.setattr(top, "HOT_SHARE", hot_share)
    df = spark.createDataFrame(odd_rows(60), "id bigint, text string").repartition(3)
    phrases = F.coalesce(top.candidate_phrases(F.col("text")), F.array().cast("array<string>"))
    cut = df.select("id", F.transform(phrases, lambda t: F.struct(t, F.lower(t))).alias("p")).collect()
    expected = plain([(r.id, [tuple(p) for p in r.p]) for r in cut])
    found = defaultdict(list)
    for r in top.ranked_topics(df, "text", "id").collect():
        found[r.id].append((r.position, r.topic, r["rank"], r.score))
    # Texts of one key may have different phrases at one place, whose order is open.
    assert set(found) == set(expected) and found[0] and found[None]
    for row, rows in found.items():
        if row in (1, None):
            assert sorted((t, s) for _, t, _, s in rows) == sorted((t, s) for _, t, _, s in expected[row])
        else:
            assert sorted(rows) == sorted(expected[row])


def test_phrases_are_not_shuffled_one_by_one(spark):
    df = spark.createDataFrame([(1, "tide tables list the hours"), (2, "the tide")], "id string, text string")
    found = top.ranked_topics(df, "text", "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert dict(found.dtypes) == {"id": "string", "position": "int", "topic": "string", "rank": "int", "score": "double"}


def test_written_tables_drop_their_shuffles(spark):
    held = spark.conf.get(session._FILE_CLEANUP, None)
    session.written(spark.range(1000).repartition(5), "dealt")
    assert spark.conf.get(session._FILE_CLEANUP, None) == held
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    before = tracker.size()
    session.written(spark.range(1000).repartition(5), "dealt")
    assert tracker.size() <= before


def test_word_scores_of_phrases_and_of_arrays(spark):
    rows = [(1, ["Linear systems", "http://a.b/c d"]), (2, ["linear"]), (3, []), (4, None)]
    arrays = spark.createDataFrame(rows, "id bigint, topics array<string>")
    one_by_one = arrays.select(F.explode("topics").alias("topic")).union(spark.createDataFrame([(None,)], "topic string"))
    found = [sorted(map(tuple, top.word_scores(*a).collect())) for a in ((arrays, "topics"), (one_by_one, "topic"))]
    five = [(w, 1, 5_000_000) for w in ("a", "b", "c", "d", "http")]
    assert found[0] == found[1] == [*five, ("linear", 2, 1_500_000), ("systems", 1, 2_000_000)]


def test_sets_in_patterns_are_flat():
    """A set in a set is a chain of tests to Java, and was tried at each word of each text."""
    from corpusmill.functions.literals import one_of

    assert "[[" not in one_of(["in", "an", "on", "un", "the", "so"], any_case=True)
