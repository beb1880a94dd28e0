import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from corpusmill.llm import simhash

from .cases import awkward_docs, awkward_rows, empty_docs, sentence

FOLD = {c: c + 32 for c in range(65, 91)}


def fingerprint(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    n = min(width, len(words))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if words else []
    ones = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def groups(codes, distance):
    """The index of each code's component by brute force."""
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    array = np.array(codes, dtype=np.uint64)
    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(array[:i] ^ array[i]) <= distance):
            root[find(i)] = find(int(j))
    return [find(i) for i in range(len(codes))]


def expected(rows, distance=4):
    codes = [fingerprint(t) for _, t in rows]
    members = defaultdict(list)
    of = groups(codes, distance)
    for i, (doc, _) in enumerate(rows):
        members[of[i]].append(doc)
    return sorted(
        ((doc, f"{codes[i]:016x}", min((d for d in members[of[i]] if d is not None), default=None)) for i, (doc, _) in enumerate(rows)),
        key=repr,
    )


def got(df):
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def clustered(rng, n_random, clusters, flips):
    codes = [rng.getrandbits(64) for _ in range(n_random)]
    for size in clusters:
        centre = rng.getrandbits(64)
        for _ in range(size):
            code = centre
            for _ in range(rng.randint(0, flips)):
                code ^= 1 << rng.randrange(64)
            codes.append(code)
    return sorted(set(codes))


def signed(code):
    return code - (1 << 64) if code >> 63 else code


def test_awkward_rows(spark):
    assert got(simhash.simhash_groups(awkward_docs(spark))) == expected(awkward_rows())
    assert got(simhash.simhash_groups(empty_docs(spark))) == []


def test_edited_texts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "_SHINGLES_AT_ONCE", 50)
    rng = random.Random(6)
    rows = []
    for _ in range(40):
        words = sentence(rng, rng.randint(1, 300)).split()
        for _ in range(rng.randint(1, 6)):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            words[rng.randrange(len(words))] = "edit" + str(rng.randrange(9))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert got(simhash.simhash_groups(docs)) == expected(rows)


@pytest.mark.parametrize("seed, cell, bucket, run", [(1, 1024, 256, 4096), (2, 6, 2, 40), (3, 20, 0, 7)])
def test_components(spark, monkeypatch, seed, cell, bucket, run):
    """Large buckets in cells, more blocks, and runs that cut groups give the same components."""
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "RUN", run)
    rng = random.Random(seed)
    codes = clustered(rng, 400, [300, 60, 2, 2, 9], 5) + [0, (1 << 64) - 1]
    codes = sorted(set(codes))
    df = spark.createDataFrame([(signed(c),) for c in codes], "code bigint").repartition(3)
    root = {r["code"]: r["root"] for r in simhash.connected(df, 4).collect()}
    assert len(root) == len(codes)
    of = groups(codes, 4)
    pairs = {(of[i], root[signed(c)]) for i, c in enumerate(codes)}
    assert len(pairs) == len(set(of)) == len(set(root.values()))


@pytest.mark.parametrize("seed", range(8))
def test_tree_against_all_pairs(monkeypatch, seed):
    monkeypatch.setattr(simhash, "_PAIRS_AT_ONCE", 64)
    rng = random.Random(seed)
    codes = clustered(rng, 30, [40, 3, 50], rng.randint(1, 6))
    codes = np.array(codes + codes[:5], dtype=np.uint64)
    owners = np.array([rng.randrange(3) for _ in codes])
    names = np.array([rng.randrange(40) * 7 for _ in codes])
    distance = rng.randint(0, 6)
    a, b = simhash.tree_links(codes, owners, names, distance)
    root = {int(n): int(n) for n in names}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i in range(len(codes)):
        for j in range(i):
            if owners[i] == owners[j] and (int(codes[i]) ^ int(codes[j])).bit_count() <= distance:
                p, q = sorted((find(int(names[i])), find(int(names[j]))))
                root[q] = p
    assert {int(x): int(y) for x, y in zip(a, b, strict=True)} == {n: find(n) for n in root if find(n) != n}


def test_cells_cut_by_batches(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(simhash, "_ROWS_AT_ONCE", 5)
    rows = pd.DataFrame({"cell": sorted([1] * 9 + [2] * 3 + [5] * 6), "code": [8] * 18, "name": range(18)})
    batches = [rows.iloc[i : i + 4] for i in range(0, 18, 4)]
    links = pd.concat(simhash._link_stream(iter(batches), 0))
    assert dict(zip(links["a"], links["b"], strict=True)) == {
        n: 0 if n < 9 else 9 if n < 12 else 12 for n in range(18) if n not in (0, 9, 12)
    }


def test_gray_order(spark):
    rng = random.Random(1)
    codes = [rng.getrandbits(64) for _ in range(200)]
    place = simhash.gray_place(np.array(codes, dtype=np.uint64))
    assert all(int(p) ^ int(p) >> 1 == c for p, c in zip(place, codes, strict=True))
    df = spark.createDataFrame([(signed(c),) for c in codes], "code bigint")
    in_order = [r[0] for r in df.orderBy(simhash.gray_order(df["code"])).collect()]
    assert in_order == [signed(c) for _, c in sorted(zip(place.tolist(), codes, strict=True))]


@pytest.mark.parametrize("n", [0, 10**5, 10**8, 10**11])
def test_masks_meet_every_close_pair(n):
    rng = random.Random(n)
    masks = [m % (1 << 64) for m in simhash.block_masks(n, 4)]
    for _ in range(300):
        apart = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not m & apart for m in masks)
