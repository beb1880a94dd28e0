import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from corpusmill.llm import minhash

from .cases import awkward_docs, awkward_rows, empty_docs, sentence

FOLD = {c: c + 32 for c in range(65, 91)}


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if 0 < len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def expected(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    out = []
    for i, (doc, _) in enumerate(rows):
        smallest = min((d for d in groups[find(i)] if d is not None), default=None)
        smallest = smallest if sets[i] else doc
        out.append((doc, len(sets[i]), smallest, doc == smallest))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r[0], r[1], r[2], r[3]) for r in df.collect()), key=repr)


def test_awkward_rows(spark):
    for width, percent in ((3, 85), (5, 80)):
        found = minhash.near_duplicates(awkward_docs(spark), width=width, percent=percent)
        assert got(found) == expected(awkward_rows(), width, percent)
    assert minhash.near_duplicates(empty_docs(spark)).count() == 0


def test_chains_of_edits(spark, monkeypatch):
    """Near copies of many degrees: links that no hub has must be found too."""
    monkeypatch.setattr(minhash, "CELL", 4)
    rng = random.Random(5)
    rows = []
    for _ in range(3):
        words = sentence(rng, 120).split()
        for _ in range(25):
            rows.append((len(rows), " ".join(words)))
            other = list(words)
            for _ in range(rng.randint(0, 5)):
                other[rng.randrange(len(other))] = "edit" + str(rng.randrange(10**6))
            rows.append((len(rows), " ".join(other)))
            words = other if rng.random() < 0.6 else words
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got(minhash.near_duplicates(docs, width=3, percent=85)) == expected(rows, 3, 85)


def test_estimates(spark):
    rng = np.random.default_rng(2)
    shared, own = rng.integers(0, 2**63, (2, 2000), dtype=np.uint64)
    rows = []
    with np.errstate(over="ignore"):
        for part in (0.5, 0.8, 1.0):
            n = int(1000 * part)
            a = np.concatenate([shared[:n], own[: 1000 - n]])
            b = np.concatenate([shared[:n], own[1000 : 2000 - n]])
            packed = [minhash._packed(minhash._minima(s)).view(np.int64).tolist() for s in (a, b)]
            rows.append((n / (2000 - n), *packed[0], *packed[1]))
    names = [f"{s}{i}" for s in "ab" for i in range(minhash.WORDS)]
    df = spark.createDataFrame(rows, ", ".join(["j double", *[f"{n} bigint" for n in names]]))
    sides = [[df[f"{s}{i}"] for i in range(minhash.WORDS)] for s in "ab"]
    for r in df.select("j", minhash.estimate(*sides).alias("e")).collect():
        assert abs(r["j"] - r["e"]) < 0.13


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9)], "a bigint, b bigint")
    roots = {r["node"]: r["root"] for r in minhash.components(links, "t").collect()}
    assert {roots[i] for i in range(100, 141)} == {100}
    assert (roots[7], roots[3], roots[9]) == (3, 3, 3)


def test_pairs_of_one_component_are_passed_over(spark):
    """Of all pairs among 60 linked classes only a few for each class are confirmed."""
    asked = []

    class Linker:
        percent = 85

        def confirmed(self, pairs):
            asked.append(pairs.count())
            return pairs

    n = 60
    pairs = spark.createDataFrame(
        [(i, j, 0.8 + 0.19 * ((i * 7 + j) % 10) / 10) for i in range(n) for j in range(i)], "a bigint, b bigint, score double"
    )
    roots = spark.range(n + 1).select(F.col("id").alias("node"), F.col("id").alias("root"))
    found = {r["node"]: r["root"] for r in minhash._joined_roots(roots, pairs, Linker(), "t").collect()}
    assert {found[i] for i in range(n)} == {0} and found[n] == n
    assert sum(asked) < 3 * n < pairs.count()
