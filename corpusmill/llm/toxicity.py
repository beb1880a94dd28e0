"""Toxicity: class-conditional Kneser-Ney models of the characters within words.

Two models, of toxic and of ordinary texts, give each character of a word a probability after
the characters before it. How often a class has a gram serves the highest order, ``ORDER``; its
continuation counts (how many different characters precede a gram in the class) serve those down to
``OWN_ORDER``, but grams at the beginning of a word, which nothing else precedes, keep plain counts. Below,
both back off to the same continuation counts, gathered from every document. An expression that neither class knows well thus gets
the same probability from both and says nothing, and the stems of rare expressions still do.

A text's score comes from length-normalised log-likelihood ratios: per character of the whole
text and of its most toxic run of ``WINDOW`` words, per word of its 1, 3 and 6 most toxic
words, and the number of words with a ratio above ``STRONG`` by the square root of all; for a
toxic text may be mostly ordinary words. Weights and a bias, fitted on labelled texts that the
models have not seen, turn them into a probability.

Nothing is capped: the continuation counts are a table of exact character pairs that grows with
the corpus. Pairs with a share of at least ``HOT_SHARE`` (there can be no more than 1,000,000) are
broadcast; a text that holds a rarer one gets its counts by a join. The grams of the two classes, of
labelled texts only, have 64-bit keys; what is kept by single characters is bounded by Unicode.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import named
from .common import free_name, keyed_texts, saved, small_batches

ORDER = 5
OWN_ORDER = 3
DISCOUNT = 0.75
WINDOW = 10
STRONG = 2.5
TOPS = (1, 3, 6)
N_FEATURES = 3 + len(TOPS)
MAX_LABELLED = 20_000
# Character pairs at least this frequent among the continuation counts are broadcast. No more
# than 1 / HOT_SHARE pairs can have that share.
HOT_SHARE = 1e-6
_CODE_BITS = 21
_CODES = 0x110000
_ONE = (1 << _CODE_BITS) - 1
_PAIR = (1 << 2 * _CODE_BITS) - 1
# What a task remembers to save work, in words, characters and grams; it starts anew beyond.
_WORDS_KEPT, _CHARS_KEPT, _GRAMS_KEPT = 200_000, 4_000_000, 1_000_000
_WORD = re.compile(r"[^\W\d_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TEXTS_AT_ONCE = 250
_CHARS_AT_ONCE = 1_000_000


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Grams:
    """The padded characters of words, and the key of each gram that ends at a character."""

    def __init__(self, words: list[str]):
        lengths = np.array([len(w) + 1 for w in words], dtype=np.int64)
        joined = "".join("\x01" * (ORDER - 1) + w + "\x02" for w in words)
        self.chars = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        ends = np.cumsum(lengths + ORDER - 1)
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.at = np.repeat(ends - lengths, lengths) + inside
        self.word = np.repeat(np.arange(len(words)), lengths)

    def key(self, first: int, last: int) -> np.ndarray:
        """A 64-bit hash of the characters from ``first`` to ``last`` places back."""
        h = np.full(len(self.at), first - last + 1, dtype=np.uint64)
        for back in range(first, last - 1, -1):
            h = (h ^ self.chars[self.at - back]) * _MIX
            h ^= h >> np.uint64(29)
        return (h * _MIX).view(np.int64)

    def gram(self, order: int) -> np.ndarray:
        return self.key(order - 1, 0)

    def context(self, order: int) -> np.ndarray:
        return self.key(order - 1, 1)

    def opens(self, order: int) -> np.ndarray:
        """Whether the gram begins before its word does."""
        return self.chars[self.at - (order - 1)] == 1

    def codes(self, order: int) -> np.ndarray:
        """The last ``order`` characters themselves, three at most."""
        out = np.zeros(len(self.at), dtype=np.int64)
        for back in range(order - 1, -1, -1):
            out = (out << _CODE_BITS) | self.chars[self.at - back].astype(np.int64)
        return out


def _look_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each wanted key in the sorted ``keys``, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class ToxicityModel:
    """What a word's characters are scored by.

    By code point: ``one``, the probability of a character by itself; ``total`` and ``rest``, the
    continuation counts after a character and what is left for the backoff. ``pairs`` and ``n_pairs``: the frequent
    pairs and their continuation counts. ``grams[order]`` and ``contexts[order]``: sorted keys with a row for
    each class (0 ordinary, 1 toxic), of discounted probabilities and of what is left for the backoff.
    """

    one: np.ndarray
    total: np.ndarray
    rest: np.ndarray
    pairs: np.ndarray
    n_pairs: np.ndarray
    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    contexts: dict[int, tuple[np.ndarray, np.ndarray]]
    known: dict[str, float] = field(default_factory=dict)

    def ratios(self, words: list[str], rare: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of each word. ``rare``: the sorted pairs, with their
        counts, that the words hold and ``pairs`` lacks."""
        grams = Grams(words)
        pair = grams.codes(2)
        at, there = _look_up(self.pairs, pair)
        n = np.where(there, self.n_pairs[at] if len(self.pairs) else 0.0, 0.0)
        if rare is not None and len(rare[0]):
            at, there = _look_up(rare[0], pair)
            n = np.where(there, rare[1][at], n)
        before = pair >> _CODE_BITS
        p = np.maximum(n - DISCOUNT, 0) / np.maximum(self.total[before], 1) + self.rest[before] * self.one[pair & _ONE]
        both = [p, p]
        for order in range(OWN_ORDER, ORDER + 1):
            keys, share = self.grams[order]
            at, there = _look_up(keys, grams.gram(order))
            own = np.where(there, share[:, at], 0.0) if len(keys) else np.zeros((2, len(pair)))
            keys, left = self.contexts[order]
            at, there = _look_up(keys, grams.context(order))
            rest = np.where(there, left[:, at], 1.0) if len(keys) else np.ones((2, len(pair)))
            both = [own[c] + rest[c] * both[c] for c in (0, 1)]
        step = np.log(np.maximum(both[1], 1e-9)) - np.log(np.maximum(both[0], 1e-9))
        return np.bincount(grams.word, step, len(words))

    def ratios_of(self, words: list[str], rare: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
        """The same; words met before are not scored again."""
        new = [w for w in words if w not in self.known]
        if new:
            if len(self.known) + len(new) > _WORDS_KEPT:
                self.known.clear()
                new = words
            self.known.update(zip(new, self.ratios(new, rare).tolist(), strict=True))
        return np.array([self.known[w] for w in words])

    def features(self, texts: list[str | None], rare: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """A row of ``N_FEATURES`` for each text; zeros without a word."""
        out = np.zeros((len(texts), N_FEATURES))
        for start, stop in _portions(texts):
            split = [words_of(t) for t in texts[start:stop]]
            kinds = {w: i for i, w in enumerate(dict.fromkeys(w for ws in split for w in ws))}
            if not kinds:
                continue
            ratio = self.ratios_of(list(kinds), rare)
            length = np.array([len(w) + 1 for w in kinds])
            for i, ws in enumerate(split):
                if not ws:
                    continue
                ids = np.fromiter((kinds[w] for w in ws), dtype=np.int64, count=len(ws))
                values = ratio[ids]
                value = np.concatenate([[0.0], np.cumsum(values)])
                chars = np.concatenate([[0], np.cumsum(length[ids])])
                k = min(WINDOW, len(ws))
                worst = (value[k:] - value[:-k]) / (chars[k:] - chars[:-k])
                top = min(max(TOPS), len(ws))
                tops = np.sort(np.partition(values, len(ws) - top)[-top:])[::-1]
                out[start + i] = [
                    value[-1] / chars[-1],
                    worst.max(),
                    (values > STRONG).sum() / np.sqrt(len(ws)),
                    *[tops[:n].mean() for n in TOPS],
                ]
        return out

    def score(
        self, texts: list[str | None], weights: tuple[float, ...], rare: tuple[np.ndarray, np.ndarray] | None = None
    ) -> np.ndarray:
        z = self.features(texts, rare) @ np.array(weights[:-1]) + weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _portions(texts):
    """Runs of texts of a bounded total size (a single huge text is its own run)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and (i - start >= _TEXTS_AT_ONCE or size + n > _CHARS_AT_ONCE):
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def _corpus_pairs(texts: DataFrame) -> DataFrame:
    """(pair, n): each pair of characters in the words of all texts, and how many different characters
    precede it. A pair is its two code points."""

    def run(batches):
        # What this task has told already; to tell a gram again makes no difference.
        words: set[str] = set()
        chars, seen = 0, np.empty(0, dtype=np.int64)
        for batch in batches:
            column = list(batch["text"])
            for start, stop in _portions(column):
                kinds = list({w for t in column[start:stop] for w in words_of(t)} - words)
                if not kinds:
                    continue
                words.update(kinds)
                chars += sum(map(len, kinds))
                if len(words) > _WORDS_KEPT or chars > _CHARS_KEPT:
                    words, chars = set(), 0
                keys = np.unique(Grams(kinds).codes(3))
                fresh = keys[~_look_up(seen, keys)[1]]
                if len(fresh):
                    seen = fresh if len(seen) > _GRAMS_KEPT else np.union1d(seen, fresh)
                    yield pd.DataFrame({"gram": fresh})

    return (
        texts.select("text")
        .mapInPandas(run, "gram bigint")
        .distinct()
        .groupBy(F.col("gram").bitwiseAND(F.lit(_PAIR)).alias("pair"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _rare_pairs(texts: DataFrame, handed: Broadcast, rare: DataFrame) -> DataFrame:
    """(version, pairs, counts) of the texts that hold pairs which the model lacks; version is the text's hash."""

    def run(batches):
        plain: set[str] = set()  # words without such a pair
        for batch in batches:
            for version, text in zip(batch["version"], batch["text"], strict=True):
                kinds = [w for w in dict.fromkeys(words_of(text)) if w not in plain]
                if not kinds:
                    continue
                grams = Grams(kinds)
                pair = grams.codes(2)
                lacks = ~_look_up(handed.value.pairs, pair)[1]
                if len(plain) > _WORDS_KEPT:
                    plain = set()
                held = np.bincount(grams.word, lacks, len(kinds)) > 0
                plain.update(w for w, h in zip(kinds, held, strict=True) if not h and len(w) < 100)
                if lacks.any():
                    yield pd.DataFrame({"pair": np.unique(pair[lacks])}).assign(version=version)

    return (
        texts.select(F.xxhash64("text").alias("version"), "text")
        .mapInPandas(run, "pair bigint, version bigint")
        .distinct()
        .join(rare, "pair")
        .groupBy("version")
        .agg(F.collect_list(F.struct("pair", "n")).alias("held"))  # the text's own pairs at most
        .select("version", F.col("held.pair").alias("pairs"), F.col("held.n").alias("counts"))
    )


def _merged(pairs: pd.Series, counts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of some texts in order, each once, and their counts."""
    held = [(p, n) for p, n in zip(pairs, counts, strict=True) if p is not None]
    if not held:
        return np.empty(0, dtype=np.int64), np.empty(0)
    found, first = np.unique(np.concatenate([p for p, _ in held]), return_index=True)
    return found, np.concatenate([n for _, n in held]).astype(float)[first]


def _class_grams(labelled: DataFrame) -> DataFrame:
    """(order, gram, context, n0, n1): the Kneser-Ney counts of each gram in the words of each class. Of the highest
    order, and of grams that begin before their word does: how often they occur; of others: how many
    different characters precede them."""

    def run(batches):
        for batch in batches:
            column, toxic = list(batch["text"]), np.array(batch["toxic"])
            for start, stop in _portions(column):
                counts: dict[str, list[int]] = {}
                for text, y in zip(column[start:stop], toxic[start:stop], strict=True):
                    for w in words_of(text):
                        counts.setdefault(w, [0, 0])[int(y)] += 1
                if not counts:
                    continue
                grams, n = Grams(list(counts)), np.array(list(counts.values()))
                for order in range(OWN_ORDER, ORDER + 1):
                    rows = pd.DataFrame(
                        {
                            "gram": grams.gram(order),
                            "context": grams.context(order),
                            "opens": grams.opens(order),
                            "lower_gram": grams.gram(order - 1),
                            "lower_context": grams.context(order - 1),
                            "lower_opens": grams.opens(order - 1),
                            "n0": n[grams.word, 0],
                            "n1": n[grams.word, 1],
                        }
                    )
                    keys = [c for c in rows.columns if c not in ("n0", "n1")]
                    yield rows.groupby(keys, as_index=False).sum().assign(order=order)

    plain = (
        labelled.select("text", "toxic")
        .mapInPandas(
            run,
            "gram bigint, context bigint, opens boolean, lower_gram bigint, lower_context bigint, lower_opens boolean, "
            "n0 bigint, n1 bigint, order int",
        )
        .groupBy("order", "gram", "context", "opens", "lower_gram", "lower_context", "lower_opens")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )
    plain = saved(plain, "class-grams")
    # A gram that is one longer is one character before its last ones.
    preceded = (
        plain.where((F.col("order") > OWN_ORDER) & ~F.col("lower_opens"))
        .groupBy((F.col("order") - 1).alias("order"), F.col("lower_gram").alias("gram"), F.col("lower_context").alias("context"))
        .agg(F.count_if(F.col("n0") > 0).alias("n0"), F.count_if(F.col("n1") > 0).alias("n1"))
    )
    return plain.where((F.col("order") == ORDER) | F.col("opens")).select(*preceded.columns).union(preceded)


def _class_model(rows: pd.DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Grams with their discounted probabilities, and contexts with the mass left to the backoff, for each class."""
    rows = rows.sort_values("gram")
    contexts, context = np.unique(rows["context"].to_numpy(), return_inverse=True)
    share, rest = [], []
    for name in ("n0", "n1"):
        n = rows[name].to_numpy()
        total = np.bincount(context, n, len(contexts))
        different = np.bincount(context, n > 0, len(contexts))
        share.append(np.maximum(n - DISCOUNT, 0) / np.maximum(total[context], 1))
        rest.append(np.where(total > 0, DISCOUNT * different / np.maximum(total, 1), 1.0))
    return (rows["gram"].to_numpy(), np.stack(share).astype(np.float32)), (contexts, np.stack(rest).astype(np.float32))


def _shared_model(pairs: DataFrame) -> tuple[dict[str, np.ndarray], DataFrame | None]:
    """The model's parts from the continuation counts, and the pairs that are too many to broadcast (None: there are none)."""

    def by_code(column: Column) -> pd.DataFrame:  # at most one row for each code point
        return pairs.groupBy(column.alias("code")).agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n")).toPandas()

    total, rest = np.zeros(_CODES), np.ones(_CODES)
    before = by_code(F.shiftright("pair", _CODE_BITS))
    code = before["code"].to_numpy(dtype=np.int64)
    total[code] = before["n"].to_numpy(dtype=float)
    rest[code] = DISCOUNT * before["kinds"].to_numpy(dtype=float) / total[code]
    last = by_code(F.col("pair").bitwiseAND(F.lit(_ONE)))
    kinds = last["kinds"].to_numpy(dtype=float)
    all_kinds = max(kinds.sum(), 1.0)
    one = np.full(_CODES, 1e-4 * (DISCOUNT * len(kinds) / all_kinds if len(kinds) else 1.0))
    one[last["code"].to_numpy(dtype=np.int64)] += np.maximum(kinds - DISCOUNT, 0) / all_kinds
    floor = float(total.sum()) * HOT_SHARE
    hot = pairs.where(F.col("n") >= floor).toPandas().sort_values("pair")
    parts = {
        "one": one,
        "total": total,
        "rest": rest,
        "pairs": hot["pair"].to_numpy(dtype=np.int64),
        "n_pairs": hot["n"].to_numpy(dtype=float),
    }
    return parts, pairs.where(F.col("n") < floor) if floor > 1 else None


def _labelled_texts(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, toxic, draw) of the labelled rows whose id hashes lowest, ``most`` ids at most."""
    slim = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc").isNotNull())
        .select("doc", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc").alias("draw"))
        .distinct()
    )
    lowest = slim.select("draw").distinct().orderBy("draw").limit(most)
    highest = lowest.agg(F.max("draw").alias("draw")).first()["draw"]
    # Bounded by ``most`` ids, with two labels each at most.
    chosen = F.broadcast(slim.where(F.col("draw") <= F.lit(highest)))
    return docs.join(chosen, "doc").select("text", "toxic", "draw")


def fit(
    docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED
) -> tuple[Broadcast, DataFrame | None, tuple[float, ...]]:
    """A model, broadcast, the pairs it leaves to a join, and its weights, from (doc, text) ``docs``, all of which feed the backoff counts, and (doc, toxic)
    ``labels``.

    The texts of at most ``max_labelled`` labelled ids, those of the smallest hash, serve
    the two classes; every fifth id calibrates the weights. Without calibration rows of both
    classes the weights are 0 and every score is a hair less than a half.
    """
    sample = saved(_labelled_texts(docs, labels, max_labelled), "labelled")
    fold = F.pmod("draw", F.lit(5))
    own = _class_grams(sample.where(fold != 0))
    parts, rare = _shared_model(saved(_corpus_pairs(docs), "corpus-pairs"))
    # Both classes together have no more grams than ``max_labelled`` texts hold.
    own_rows = own.toPandas()
    grams, contexts = {}, {}
    for order in range(OWN_ORDER, ORDER + 1):
        grams[order], contexts[order] = _class_model(own_rows[own_rows["order"] == order])
    handed = docs.sparkSession.sparkContext.broadcast(ToxicityModel(**parts, grams=grams, contexts=contexts))

    def measure(batches):
        for batch in batches:
            more = _merged(batch["pairs"], batch["counts"]) if rare_there else None
            yield pd.DataFrame(
                handed.value.features(list(batch["text"]), more), columns=[f"f{i}" for i in range(N_FEATURES)]
            ).assign(toxic=batch["toxic"].to_numpy())

    rare_there = rare is not None
    known = sample.where(fold == 0).select("text", "toxic")
    if rare_there:
        known = known.withColumn("version", F.xxhash64("text")).join(
            _rare_pairs(known, handed, rare), "version", "left"
        )
    fields = ", ".join(f"f{i} double" for i in range(N_FEATURES))
    seen = known.mapInPandas(measure, f"{fields}, toxic int")
    return handed, rare, _weights(seen.toPandas())


def _weights(seen: pd.DataFrame) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps."""
    y = seen["toxic"].to_numpy(dtype=float)
    if len(set(y)) < 2:
        return (*[0.0] * N_FEATURES, -1e-6)
    x = np.column_stack([seen.drop(columns="toxic"), np.ones(len(y))])
    scale = np.append(x[:, :-1].std(axis=0) + 1e-9, 1.0)
    x = x / scale
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + 0.3 * np.eye(len(w))
        w = w + np.linalg.solve(curve, x.T @ (y - p) - 0.3 * w)
    return tuple(w / scale)


def with_scores(
    docs: DataFrame, handed: Broadcast, rare: DataFrame | None, weights: tuple[float, ...], text: str, name: str
) -> DataFrame:
    """The input and a column ``name`` with the score of each whole text, from the text alone.

    Narrow while the model has all pairs; else the texts with rare pairs are joined with their counts.
    """
    content = F.coalesce(named(text).cast("string"), F.lit(""))
    if rare is None:

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            return pd.Series(handed.value.score(list(texts), weights))

        return docs.withColumn(name, score(content))

    @F.pandas_udf("double")
    def score_with(texts: pd.Series, pairs: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series(handed.value.score(list(texts), weights, _merged(pairs, counts)))

    version, pairs, counts = (free_name(docs, c) for c in ("version", "pairs", "counts"))
    held = _rare_pairs(docs.select(content.alias("text")), handed, rare).toDF(version, pairs, counts)
    joined = docs.withColumn(version, F.xxhash64(content)).join(held, version, "left")
    return joined.withColumn(name, score_with(content, pairs, counts)).drop(version, pairs, counts)


def held_out(key: Column) -> Column:
    """crc32 of the id as text is a multiple of 5 (false for a null id)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """The input with held_out, score (0 to 1) and predicted (1 from 0.5) under free names.

    Labels are learned only from rows that are not held out; conflicting labels of one id are
    all used. A null text is empty; a text without a word scores as one whose ratios
    are all 0. Equal texts score alike. An empty table gives an empty table; without
    labels of both classes nothing is predicted toxic.
    """
    small_batches(docs.sparkSession)
    known = labels.select(F.col(key).alias("doc"), F.col(label).alias("toxic")).where(
        ~held_out(F.col("doc"))
    )
    handed, rare, weights = fit(keyed_texts(docs, key, text), known, max_labelled)
    score = free_name(docs, "score")
    scored = with_scores(docs, handed, rare, weights, text, score)
    return scored.select(
        *[named(c) for c in docs.columns],
        held_out(named(key)).alias(free_name(docs, "held_out")),
        F.col(score),
        (F.col(score) >= 0.5).cast("int").alias(free_name(docs, "predicted")),
    )
