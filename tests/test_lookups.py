"""Bloom filters, probes of large vocabularies, and integrity behind a filter."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.text import pieces
from corpusmill.operators import bloom, entities, integrity, lookups


def test_bloom_filter_keeps_all_and_drops_most(spark):
    held, others = list(range(0, 6000, 2)), list(range(1, 6001, 2))
    table = spark.createDataFrame([(v,) for v in held * 2] + [(None,)], "v bigint")
    found = bloom.BloomFilter.of(table, "v")
    assert found.words.count() * 64 == found.bits >= 10 * len(held)
    probe = spark.createDataFrame([(v,) for v in held + others] + [(None,)], "v bigint")
    rows = probe.select("v", found.might_hold(F.col("v")).alias("m")).collect()
    passed = {r.v for r in rows if r.m}
    assert passed >= set(held)
    assert len(passed & set(others)) < 0.03 * len(others)
    assert [r.m for r in rows if r.v is None] == [None]


def test_bounded_filter_still_keeps_all(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_BITS", 1 << 10)
    table = spark.range(5000).select(F.concat(F.lit("k"), F.col("id")).alias("v"))
    found = bloom.BloomFilter.of(table, "v")
    assert found.bits == 1 << 10
    assert table.where(found.might_hold(F.col("v"))).count() == 5000


@pytest.mark.parametrize("values", [
    ["a", "b", "", "é"], [1, 2, -3], [date(2024, 1, 1), date(1900, 5, 5)], [Decimal("1.50"), Decimal("-2.00")], [True, False],
])
def test_filter_of_any_type(spark, values):
    kind = {str: "string", int: "int", date: "date", Decimal: "decimal(9,2)", bool: "boolean"}[type(values[0])]
    table = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    assert table.where(bloom.BloomFilter.of(table, "v").might_hold(F.col("v"))).count() == len(values)


def test_empty_table_holds_nothing(spark):
    table = spark.createDataFrame([], "v string")
    probe = spark.createDataFrame([("a",), ("",)], "v string")
    assert probe.where(bloom.BloomFilter.of(table, "v").might_hold(F.col("v"))).count() == 0


def test_only_runs_that_open_a_phrase_are_shuffled(spark):
    """The rows that meet a large gazetteer: runs whose first piece opens a phrase."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    phrases = [f"{w} {w}x" for w in words[:5]] + ["w7", "w9 of the w1"]
    texts = [(i, " ".join(rng.choices(words, k=200))) for i in range(40)] + [(90, None), (91, "")]
    docs = spark.createDataFrame(texts, "id int, text string")
    gazetteer = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    spans = sorted({len(r[0]) for r in gazetteer.select(pieces(F.col("phrase"))).collect()}, reverse=True)
    probes = entities.phrase_probes(docs, "id", F.col("text"), gazetteer, spans)
    opening = {p.split(" ")[0] for p in phrases}
    starts = sum(w in opening for _, t in texts if t for w in t.split(" "))
    n_places = sum(2 * len(t.split(" ")) - 1 for _, t in texts if t)
    assert starts <= probes.select("_row", "_entry").count() / 1.0 <= len(spans) * (starts + 0.02 * n_places)
    assert probes.count() < 0.02 * n_places * len(spans)
    plan = probes._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("share", [1e-5, 0.2, 2.0])
def test_frequent_and_rare_entries_match_alike(spark, monkeypatch, share):
    monkeypatch.setattr(lookups, "HOT_SHARE", share)
    docs = spark.createDataFrame(
        [(i, ["the", f"w{i}", f"w{i % 3}", None, "none"]) for i in range(50)] + [(90, None), (91, [])], "id int, ws array<string>"
    )
    table = spark.createDataFrame([("the", 1.0), ("the", 2.0)] + [(f"w{i}", float(i)) for i in range(20)], "word string, weight double")
    probes = lookups.probes_of(docs, "id", F.col("ws"))
    found = lookups.attach_matches(docs, "id", probes, table, "word", "weight", "m").collect()
    expected = {i: {"the": 1.0, f"w{i % 3}": float(i % 3)} | ({f"w{i}": float(i)} if i < 20 else {}) for i in range(50)}
    assert {r["id"]: r["m"] for r in found} == expected | {90: None, 91: None}


def test_integrity_behind_a_filter(spark):
    child = spark.createDataFrame([(i % 50, "g" if i % 2 else "h") for i in range(500)] + [(None, "g")], "ref int, g string")
    parent = spark.createDataFrame([(v,) for v in (1, 2, 2, 3, 900, None)], "key int")
    wide = parent.select(F.col("key").cast("bigint").alias("key"))
    for table in (parent, wide, parent.limit(0)):
        plain = integrity.integrity(child, {"ref": (table, "key")}).collect()
        assert integrity.integrity(child, {"ref": (table, "key")}, filtered=True).collect() == plain
        lost = [sorted(integrity.orphans(child, "ref", table, "key", f).collect()) for f in (False, True)]
        assert lost[0] == lost[1]


def test_few_values_are_joined_behind_a_filter(spark):
    """The join's child side has what the filter lets through: here a few of 20,000 values."""
    child = spark.range(20_000).select(F.col("id").alias("ref"))
    parent = spark.createDataFrame([(5,), (17,)], "key bigint")
    tested = bloom.BloomFilter.of(parent, "key").might_hold(F.col("ref"))
    assert 2 <= child.where(tested).count() < 200
    assert integrity.orphans(child, "ref", parent, "key", True).count() == 19_998
