import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm import resample

from .cases import awkward_docs, awkward_rows, empty_docs, sentence

FOLD = {c: c + 32 for c in range(65, 91)}
FIELDS = "doc_id bigint, text string"


def features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return words, runs


def expected(rows, target, longest=1, buckets=10_000, percent=10, least=20):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, features(text, longest)[1]))
    for text in target:
        t.update(map(bucket, features(text, longest)[1]))
    all_s, all_t = s.total(), t.total()
    out, eligible = [], []
    for doc, text in rows:
        words, runs = features(text, longest)
        weight = sum(
            math.floor(1000 * math.log(((t[b] + 1) * (all_s + buckets)) / ((s[b] + 1) * (all_t + buckets))))
            for b in map(bucket, runs)
        )
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(runs), weight, score, None])
        if len(words) >= least:
            eligible.append(out[-1])
    eligible.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, out), key=repr)


def got(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("longest, percent", [(1, 50), (2, 30), (3, 100)])
def test_awkward_rows(spark, monkeypatch, longest, percent):
    monkeypatch.setattr(resample, "_WORDS_AT_ONCE", 7)  # runs of words cross the parts
    target = [sentence(random.Random(8), 30), None, "", "The no id AT all", "é ß 7,5"]
    items = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    found = got(resample.resample(awkward_docs(spark), items, longest=longest, percent=percent, buckets=500))
    assert found == expected(awkward_rows(), target, longest, 500, percent)


def test_production_values_and_ties(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, rng.randint(1, 60))) for i in range(400)]
    rows += [rows[0]] * 5 + [(900, None), (901, ""), (902, "a-b_c\x7fd e\x00f \U0001f600 Ä")]
    target = [sentence(rng, 25) for _ in range(20)]
    docs = spark.createDataFrame(rows, FIELDS).repartition(5)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    assert got(resample.resample(docs, items)) == expected(rows, target)


def test_empty_tables(spark):
    items = spark.createDataFrame([("a b",)], "text string")
    assert got(resample.resample(empty_docs(spark), items)) == []
    rows = [(1, "a b c " * 10), (2, None)]
    docs = spark.createDataFrame(rows, FIELDS)
    assert got(resample.resample(docs, items.limit(0), percent=100)) == expected(rows, [], percent=100)


def test_ranks_go_on_over_ranges_and_ties(spark):
    rows = [(i % 7, i % 3, i) for i in range(500)] + [(None, 1, 777)]
    df = spark.createDataFrame(rows, "doc bigint, score bigint, place bigint").repartition(6)
    order = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0, r[2]))
    ranks = {(r["doc"], r["score"], r["place"]): r["rank"] for r in resample.ranked(df, 400).collect()}
    assert ranks == {r: (n if n <= 400 else None) for n, r in enumerate(order, 1)}


def test_no_run_crosses_texts():
    texts = [b"a b", b"", b"c", b"\x00d"]
    parts = list(resample.batch_features(texts, 2, 1 << 32))
    docs = np.concatenate([p[1] for p in parts])
    found = Counter(zip(docs.tolist(), np.concatenate([p[2] for p in parts]).tolist(), strict=True))
    assert found == Counter((d, zlib.crc32(f)) for d, f in [(0, b"a"), (0, b"b"), (0, b"a b"), (2, b"c"), (3, b"d")])
