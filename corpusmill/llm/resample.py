"""Importance resampling towards a target distribution.

Words and runs of words fall into hashed buckets. A bucket's gain is the log ratio of its share in a
target corpus and in the documents; a document's weight is the sum of the gains of its features.
Gumbel noise from a hash of the id makes the highest scores a draw without replacement.

Texts are taken by the batch: joined with a separator byte, searched by one regular expression, and
every run of words whose first word lies in another text than its last is masked out.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import named
from .common import saved, small_batches

_SEPARATOR = b"\x00"
# Digits, letters and all bytes of characters beyond ASCII, in text whose A-Z are lower-cased.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_WORDS_AT_ONCE = 1 << 18


def batch_features(texts: list[bytes], longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document of each word, document of each feature, bucket of each feature), in parts.

    A feature is a run of 1 to ``longest`` consecutive words of one document. Parts hold
    ``_WORDS_AT_ONCE`` words, so that a very long text costs no more memory than others; the last
    ``longest - 1`` words of a part are carried into the next.
    """
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    joined = _SEPARATOR.join(texts).lower()
    matches = _WORD.finditer(joined)
    held: list[bytes] = []
    held_docs = np.empty(0, dtype=np.int64)
    while found := list(islice(matches, _WORDS_AT_ONCE)):
        starts = np.fromiter((m.start() for m in found), dtype=np.int64, count=len(found))
        fresh_docs = np.searchsorted(offsets, starts, side="right") - 1
        words = held + [m.group() for m in found]
        docs = np.concatenate([held_docs, fresh_docs])
        of_doc, of_bucket = [], []
        hashes: list[int] = []
        for run in range(1, longest + 1):
            if run > len(words):
                break
            if run == 1:
                hashes = [zlib.crc32(w) for w in words]
            else:  # the checksum goes on where that of the shorter run ended
                hashes = [zlib.crc32(w, zlib.crc32(b" ", h)) for h, w in zip(hashes, words[run - 1 :], strict=False)]
            # Runs that end in a held word were told with the part before.
            first = max(0, len(held) - run + 1)
            begin, end = docs[first : len(docs) - run + 1], docs[first + run - 1 :]
            inside = begin == end
            crc = np.array(hashes[first:], dtype=np.int64)
            of_doc.append(begin[inside])
            of_bucket.append(crc[inside] % buckets)
        yield fresh_docs, np.concatenate(of_doc), np.concatenate(of_bucket)
        keep = longest - 1
        held, held_docs = (words[-keep:], docs[-keep:]) if keep else ([], held_docs)


def _as_bytes(column: Iterable) -> list[bytes]:
    return [b"" if t is None else bytes(t) for t in column]


def bucket_counts(rows: DataFrame, text: str = "text", longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """How often each bucket occurs in the table: ``buckets`` numbers, whatever its size.

    Each task adds up its rows and hands over at most ``buckets`` sums. Null texts hold nothing; an
    empty table gives zeros.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, of_bucket in batch_features(_as_bytes(batch["text"]), longest, buckets):
                total += np.bincount(of_bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    small_batches(rows.sparkSession)
    counted = (
        rows.select(named(text).cast("string").cast("binary").alias("text"))
        .mapInPandas(count, "bucket bigint, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    out = np.zeros(buckets, dtype=np.int64)
    for r in counted:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    n, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(float((int(t) + 1) * (all_s + n)) / float((int(s) + 1) * (all_t + n))))
            for s, t in zip(source, target, strict=True)
        ],
        dtype=np.int64,
    )


def weigh(docs: DataFrame, of_bucket: np.ndarray, key: str = "doc_id", text: str = "text", longest: int = 1) -> DataFrame:
    """(key, n_words, n_features, weight): the sum of the gains of each document's features. A narrow
    pass; the gains go along with the function."""
    buckets = len(of_bucket)

    @F.pandas_udf("struct<n_words bigint, n_features bigint, weight bigint>")
    def weighed(texts: pd.Series) -> pd.DataFrame:
        n = len(texts)
        words, features, weight = (np.zeros(n, dtype=np.int64) for _ in range(3))
        for doc_of_word, doc, bucket in batch_features(_as_bytes(texts), longest, buckets):
            words += np.bincount(doc_of_word, minlength=n)
            features += np.bincount(doc, minlength=n)
            # Sums of whole numbers below 2 ** 53 are exact in doubles.
            weight += np.bincount(doc, weights=of_bucket[bucket], minlength=n).astype(np.int64)
        return pd.DataFrame({"n_words": words, "n_features": features, "weight": weight})

    small_batches(docs.sparkSession)
    return docs.select(
        named(key).alias("doc"), weighed(named(text).cast("string").cast("binary")).alias("f")
    ).select("doc", "f.*")


def ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """``rows`` (doc, score, place) with ``rank``: 1, 2, 3 by falling score, ties by the smaller
    id, null ids last, then by ``place``, which is unique; null beyond ``drawn``.

    Rows are dealt by ranges of that order and numbered in each; what lies before a range is a sum over
    one row per partition. No row meets all others.
    """
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last(), F.col("place").asc()]
    numbered = saved(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("number", F.monotonically_increasing_id())
        .withColumns({"part": F.shiftright("number", 33), "at": F.col("number").bitwiseAND(F.lit((1 << 33) - 1))})
        .drop("number"),
        "ranges-by-score",
    )
    before = (
        numbered.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr("part", "coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier")
    )
    place = F.col("earlier") + F.col("at") + 1
    return numbered.join(F.broadcast(before), "part").select(
        "*", F.when(place <= F.lit(drawn), place).alias("rank")
    ).drop("part", "at", "earlier")


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    longest: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """(key, n_features, weight, score, rank) for each row of ``docs``.

    ``rank`` numbers the floor(percent * N / 100) rows with the highest scores, of the N rows
    with at least ``least_words`` words; the others have none. Null and empty texts have no
    features and the weight 0. Rows with one id have the same noise; equal rows have equal scores and
    ranks next to each other. A null id counts as an empty one in the noise and comes last among
    equal scores. A very long text is taken in parts. An empty table gives an empty table, an
    empty target only the smoothing's gains. Other columns are not read, so they cannot clash.

    Two passes over the texts, one to count buckets and one to weigh; what is shuffled is at most
    ``buckets`` sums from a task, and the scores of the rows that may be drawn.
    """
    source_counts = bucket_counts(docs, text, longest, buckets)
    of_bucket = gains(source_counts, bucket_counts(target, target_text, longest, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")
    scored = saved(
        weigh(docs, of_bucket, key, text, longest)
        .withColumn("score", F.col("weight") + noise)
        .withColumn("place", F.monotonically_increasing_id()),
        "scores",
    )
    may_be_drawn = F.col("n_words") >= least_words
    eligible = scored.where(may_be_drawn)
    drawn = percent * eligible.count() // 100
    fields = ["doc", "n_features", "weight", "score"]
    rest = scored.where(~may_be_drawn).select(*fields, F.lit(None).cast("bigint").alias("rank"))
    return ranked(eligible, drawn).select(*fields, "rank").union(rest).withColumnRenamed("doc", key)
