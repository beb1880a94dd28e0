"""Best-fit packing of token sequences.

Best-fit decreasing looks at lengths only, and lengths are whole numbers up to the capacity.
So Spark counts the pieces of each length, the driver places those counts (at most
``capacity`` numbers, whatever the corpus) by best fit with a segment tree over the remaining
capacities, and Spark deals the places to the pieces by their rank among equal lengths.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed_texts, saved, small_batches

CAPACITY = 2048
_CHUNK = 64


class RemainingTree:
    """A segment tree over remaining capacities: how many open bins have each."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size < capacity + 1:
            self.size *= 2
        self.bins = [0] * (2 * self.size)

    def add(self, remaining: int, n: int) -> None:
        at = remaining + self.size
        while at:
            self.bins[at] += n
            at //= 2

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of an open bin that takes ``length``."""
        at = length + self.size
        if self.bins[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.bins[at + 1]:
                at += 1
                break
            at //= 2
        else:
            return None
        while at < self.size:
            at = 2 * at if self.bins[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over (length: how many pieces).

    Returns runs (length, first rank, pieces, first bin, pieces per bin, first offset): pieces
    of one length go to a range of bins that all have the same room. A bin that got a piece
    has the least room that fits the next equal one, so it takes as many as fit at once.
    Each step over a range of bins uses it up, or all pieces of the length, and leaves at most two
    ranges more than before: the work is bounded by the capacity, not by the pieces.
    """
    tree = RemainingTree(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}
    runs = []
    next_bin = 0

    def leave(first: int, n: int, room: int) -> None:
        if n and room:
            open_bins.setdefault(room, []).append((first, n))
            tree.add(room, n)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                per_bin = room // length
                first, n = next_bin, -(-left // per_bin)
                next_bin += n
            else:
                first, n = open_bins[room].pop()
                tree.add(room, -n)
                per_bin = room // length
            whole = min(n, left // per_bin)
            rest = left - whole * per_bin if whole < n else 0
            placed = whole * per_bin + rest
            runs.append((length, rank, placed, first, per_bin, capacity - room))
            leave(first, whole, room - per_bin * length)
            used = whole
            if rest:
                leave(first + whole, 1, room - rest * length)
                used += 1
            leave(first + used, n - used, room)
            rank += placed
            left -= placed
    return runs


@lru_cache(maxsize=2)
def _encoder(path: str):
    """Text -> ids of the tokenizer file at ``path``.

    The file's merges are run by tiktoken, several times as fast and with the same ids; a text
    that holds the string of a special token goes through the tokenizers library itself.
    """
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer, pre_tokenizers

    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        stored = json.load(f)
    special = [t["content"] for t in stored.get("added_tokens", [])]
    # The letters that stand for bytes: printable ones for themselves, the others from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    letters = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}
    assert set(letters) == set(pre_tokenizers.ByteLevel.alphabet())
    ranks = {
        bytes(letters[c] for c in token): rank
        for token, rank in stored["model"]["vocab"].items()
        if token not in special
    }
    fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return whole.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def _pieces_of(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32): the first takes what is over, the others are full."""
    n = -(-len(ids) // capacity)
    start = 0
    for piece in range(n):
        end = len(ids) - (n - 1 - piece) * capacity
        yield piece, start, end - start, zlib.crc32(ids[start:end].astype("<u4").tobytes())
        start = end


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """(doc, piece, start, length, ids_crc32, part, local): every document's ids, cut where
    they exceed the capacity.

    ``part`` and ``local`` number the pieces of one length within a task. A task that runs
    again reads the same rows, so it numbers them alike.
    """

    def run(batches):
        from pyspark import TaskContext

        encode = _encoder(tokenizer)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for at in range(0, len(batch), _CHUNK):
                some = batch.iloc[at : at + _CHUNK]
                rows = []
                for doc, text in zip(some["at"], some["text"], strict=True):
                    ids = np.array(encode(text) + [end_id], dtype=np.uint32)
                    for piece, start, length, crc in _pieces_of(ids, capacity):
                        rows.append((doc, piece, start, length, crc, part, seen[length]))
                        seen[length] += 1
                yield pd.DataFrame(
                    rows, columns=["doc", "piece", "start", "length", "ids_crc32", "part", "local"]
                )

    # As text, since pandas has no whole numbers with nulls.
    return docs.select(F.col("doc").cast("string").alias("at"), "text").mapInPandas(
        run,
        f"doc string, piece int, start bigint, length bigint, ids_crc32 bigint, part int, local bigint",
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    capacity: int = CAPACITY,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset): each piece's place.

    ``tokenizer`` is the path of a byte-level BPE file. A document is its ids and then
    ``end_id``; a null or empty text is ``end_id`` alone. Only a document longer than
    ``capacity`` is cut; its first piece takes what is over. Sequences have no gaps. Each row
    is packed, repeated rows and null ids too. An empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    pieces = saved(token_pieces(keyed_texts(docs, key, text), tokenizer, end_id, capacity), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    offsets = by_part.selectExpr(
        "length",
        "part",
        "sum(n) OVER (PARTITION BY length ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS first_rank",
    )
    # At most one row per length: bounded by the capacity.
    counts = {
        r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    runs = docs.sparkSession.createDataFrame(
        best_fit_runs(counts, capacity),
        "run_length bigint, run_rank bigint, run_pieces bigint, first_bin bigint, per_bin bigint, first_offset bigint",
    )
    per_length = runs.groupBy("run_length").agg(
        F.sort_array(
            F.collect_list(F.struct("run_rank", "run_pieces", "first_bin", "per_bin", "first_offset"))
        ).alias("runs")
    )
    ranked = pieces.join(offsets, ["length", "part"]).withColumn("rank", F.col("first_rank") + F.col("local"))
    run = F.get(
        F.filter(
            "runs", lambda r: (r["run_rank"] <= F.col("rank")) & (F.col("rank") < r["run_rank"] + r["run_pieces"])
        ),
        F.lit(0),
    )
    placed = ranked.join(F.broadcast(per_length), F.col("length") == F.col("run_length")).withColumn("run", run)
    nth = F.col("rank") - F.col("run.run_rank")
    return placed.select(
        F.col("doc").cast(docs.schema[key].dataType).alias(key),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("run.first_bin") + F.expr("(rank - run.run_rank) div run.per_bin")).alias("sequence_id"),
        (F.col("run.first_offset") + nth % F.col("run.per_bin") * F.col("length")).alias("offset"),
    )
