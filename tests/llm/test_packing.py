import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusmill.llm.packing import RemainingTree, best_fit_runs, pack

from .cases import awkward_docs, awkward_rows, empty_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_best_fit(lengths, capacity):
    rooms, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(rooms, length)
        n += at == len(rooms)
        room = capacity if at == len(rooms) else rooms.pop(at)
        insort(rooms, room - length)
    return n, Counter(r for r in rooms)


@pytest.mark.parametrize("seed", range(30))
def test_runs_are_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([5, 17, 64, 100])
    lengths = [min(capacity, 1 + int(rng.expovariate(3 / capacity))) for _ in range(rng.randint(1, 400))]
    bins, ranks = defaultdict(list), defaultdict(set)
    for length, rank, n, first, each, offset in best_fit_runs(Counter(lengths), capacity):
        for k in range(n):
            bins[first + k // each].append((offset + k % each * length, length))
            ranks[length].add(rank + k)
    assert {k: len(v) for k, v in ranks.items()} == dict(Counter(lengths))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    n, rooms = plain_best_fit(lengths, capacity)
    assert len(bins) == n
    assert Counter(capacity - sum(x[1] for x in p) for p in bins.values()) == rooms


def test_tree_finds_the_tightest():
    tree = RemainingTree(10)
    assert tree.tightest(1) is None
    for room in (3, 7, 10):
        tree.add(room, 1)
    assert [tree.tightest(n) for n in range(1, 11)] == [3, 3, 3, 7, 7, 7, 7, 10, 10, 10]
    tree.add(7, -1)
    assert tree.tightest(4) == 10


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = pack(docs, PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    wanted, got = Counter(), Counter()
    for doc, text in awkward_rows():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        n = -(-len(ids) // 2048)
        ends = [len(ids) - 2048 * k for k in range(n)][::-1]
        for piece, (a, b) in enumerate(zip([0, *ends], ends)):
            wanted[doc, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    filled = defaultdict(list)
    for r in rows:
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == wanted
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_special_strings_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id bigint, text string")
    ids = Tokenizer.from_file(PATH).encode("a <|endoftext|> b", add_special_tokens=False).ids + [0]
    assert pack(docs, PATH).first()["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    assert pack(empty_docs(spark), PATH).count() == 0
