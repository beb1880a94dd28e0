"""Near-duplicate documents by b-bit MinHash.

Every text becomes the set of its word shingles and, over ``BANDS * ROWS`` hash functions,
the minima of the set. Bands of minima give candidates. Of each minimum only the low ``BITS`` bits
stay, packed into words; counting equal groups of bits estimates the similarity, corrected for
chance collisions, and candidates far below the threshold fall away. The others are
confirmed on the full sets.

Texts with one shingle set are one class, whatever their number. In a bucket of a band one class
is the hub; classes are compared with the hubs of their buckets, not with each other. Links make
components. What then shares a bucket without being in its largest component is compared with all
others there, in cells of bounded size: so no link between components is lost, and work beyond
the linear only arises where texts share buckets but are not linked. Likely pairs are confirmed the likeliest
first, and those that are in one component by then are passed over.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved, small_batches

BANDS = 40
ROWS = 6
BITS = 4
WORDS = BANDS * ROWS * BITS // 64
MARGIN = 4.0
CELL = 256
FINE = 1024
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PRODUCTS = 500_000  # of shingles and hash functions at once
_LOW = 0x1111111111111111


def _functions(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``n`` hash functions."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 2**63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, rng.integers(0, 2**63, size=n, dtype=np.uint64)


_COARSE_FUNCTIONS = _functions(20, BANDS * ROWS)
_FINE_FUNCTIONS = _functions(21, FINE)


def _mixed(parts) -> np.ndarray:
    h = np.uint64(0)
    for part in parts:
        h = (h ^ part) * _MIX
        h = h ^ (h >> np.uint64(29))
    return h


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles. Words are runs without ASCII white space,
    A-Z lower-cased; fewer than ``width`` of them are one shingle, none give the empty set."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))
    with np.errstate(over="ignore"):
        if len(words) < width:
            return np.array([_mixed([*hashes, np.uint64(len(words))])], dtype=np.uint64)
        n = len(words) - width + 1
        return np.unique(_mixed([hashes[i : i + n] for i in range(width)]))


def _minima(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray] = _COARSE_FUNCTIONS) -> np.ndarray:
    factors, offsets = functions
    step = max(1, _PRODUCTS // len(factors))
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), step):
        part = shingles[None, at : at + step] * factors[:, None] + offsets[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def _packed(minima: np.ndarray) -> np.ndarray:
    low = (minima >> np.uint64(20)) & np.uint64((1 << BITS) - 1)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(low.reshape(-1, 64 // BITS) << shifts, axis=1)


def _band_keys(minima: np.ndarray) -> np.ndarray:
    return _mixed([np.arange(1, BANDS + 1, dtype=np.uint64), *minima.reshape(BANDS, ROWS).T])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _fine_signature(sets: pd.Series) -> pd.Series:
    with np.errstate(over="ignore"):
        return pd.Series(
            [_packed(_minima(np.frombuffer(s, dtype=np.uint64), _FINE_FUNCTIONS)).view(np.int64) for s in sets],
            dtype=object,
        )


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """The input with ``m``: struct<set_id, n, packed, bands>; n is 0 for an empty set.

    ``set_id`` is a 64-bit hash of the whole set.
    """

    @F.pandas_udf("struct<set_id bigint, n int, packed array<bigint>, bands array<bigint>>")
    def sign(texts: pd.Series) -> pd.DataFrame:
        rows = []
        none = np.empty(0, dtype=np.int64)
        with np.errstate(over="ignore"):
            for text in texts:
                shingles = shingle_set(text, width)
                if not len(shingles):
                    rows.append((0, 0, none, none))
                    continue
                minima = _minima(shingles)
                set_id = np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64)
                rows.append(
                    (set_id, len(shingles), _packed(minima).view(np.int64), _band_keys(minima).view(np.int64))
                )
        return pd.DataFrame(rows, columns=["set_id", "n", "packed", "bands"])

    return docs.withColumn("m", sign("text"))


def _equal_groups(a: Column, b: Column) -> Column:
    """How many groups of bits two words share."""
    x = a.bitwiseXOR(b)
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(_LOW))
    return F.lit(64 // BITS) - F.bit_count(x)


def _corrected(equal: Column, functions: int) -> Column:
    chance = 1 / 2**BITS
    return (equal / functions - chance) / (1 - chance)


def estimate(left: list[Column], right: list[Column]) -> Column:
    """Similarity from packed words: the share of equal groups of bits, less chance collisions."""
    equal = F.lit(0)
    for a, b in zip(left, right, strict=True):
        equal = equal + _equal_groups(a, b)
    return _corrected(equal, BANDS * ROWS)


def _fine_estimate(left: Column, right: Column) -> Column:
    equal = F.aggregate(F.zip_with(left, right, _equal_groups), F.lit(0), lambda n, x: n + x)
    return _corrected(equal, FINE)


def _bound(similarity: float, functions: int = BANDS * ROWS) -> float:
    """What an estimate of a linked pair falls below with a chance of 3 in 100,000 at most."""
    chance = 1 / 2**BITS
    p = similarity + (1 - similarity) * chance
    return similarity - MARGIN * (p * (1 - p) / functions) ** 0.5 / (1 - chance)


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, root): each node of ``links`` (a, b) with the smallest node it reaches.

    Labels take the minimum over neighbours and then over the label's own label, until
    none changes; nothing is gathered by node, and every round is a written table.
    """
    both = saved(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{label}-links")
    roots = saved(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")),
        f"{label}-roots",
    )
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").select(
            F.col("a").alias("node"), "root", F.lit(None).cast("bigint").alias("old")
        )
        least = (
            near.union(roots.select("node", "root", F.col("root").alias("old")))
            .groupBy("node")
            .agg(F.min("root").alias("root"), F.min("old").alias("old"))
        )
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("further"))
        stepped = saved(
            least.join(jump, "root", "left").select(
                "node", F.least("root", "further").alias("root"), "old"
            ),
            f"{label}-roots",
        )
        roots = stepped.select("node", "root")
        if stepped.where(F.col("root") != F.col("old")).isEmpty():
            return roots


class _Linker:
    """Confirms candidate pairs of set ids on estimates and then on full sets."""

    def __init__(self, classes: DataFrame, sets: DataFrame, percent: int):
        self.classes, self.sets, self.percent = classes, sets, percent

    def _sizes_fit(self, n: Column, m: Column) -> Column:
        return F.lit(100).cast("bigint") * F.least(n, m) >= F.lit(self.percent).cast("bigint") * F.greatest(n, m)

    def likely(self, a: dict[str, Column], b: dict[str, Column]) -> Column:
        return self._sizes_fit(a["n"], b["n"]) & (
            estimate([a[f"w{i}"] for i in range(WORDS)], [b[f"w{i}"] for i in range(WORDS)])
            >= _bound(self.percent / 100)
        )

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that may be linked by size and estimate, with the estimate as score."""
        fields = ["n", *[f"w{i}" for i in range(WORDS)]]
        for side in ("a", "b"):
            own = self.classes.select(
                F.col("set_id").alias(side), *[F.col(f).alias(f"{side}_{f}") for f in fields]
            )
            pairs = pairs.join(own, side)
        sides = [{f: F.col(f"{s}_{f}") for f in fields} for s in ("a", "b")]
        words = [[side[f] for f in fields[1:]] for side in sides]
        return pairs.where(self.likely(*sides)).select("a", "b", estimate(*words).alias("score"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets have an intersection of at least ``percent`` of the union."""
        percent = self.percent

        @F.pandas_udf("boolean")
        def linked(left: pd.Series, right: pd.Series) -> pd.Series:
            out = []
            for x, y in zip(left, right, strict=True):
                a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                small, large = (a, b) if len(a) <= len(b) else (b, a)
                at = np.searchsorted(large, small)
                same = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                out.append(100 * same >= percent * (len(a) + len(b) - same))
            return pd.Series(out, dtype=bool)

        for side in ("a", "b"):
            pairs = pairs.join(
                self.sets.select(F.col("set_id").alias(side), F.col("shingles").alias(f"{side}_set")), side
            )
        return pairs.where(linked("a_set", "b_set")).drop("a_set", "b_set")


def _joined_roots(roots: DataFrame, pairs: DataFrame, linker: _Linker, label: str) -> DataFrame:
    """``roots`` (node, root) of all classes that share a bucket, after the links among ``pairs`` (a, b, score).

    The likeliest partner of each class comes first, then pairs estimated at the threshold or above,
    then all others; pairs that are in one component by then are passed over. So a group of copies is
    joined by few pairs for each member, and each round's links only join components of the one before.
    """
    pairs = saved(pairs, f"{label}-pairs")
    at_threshold = F.col("score") >= linker.percent / 100
    best = pairs.groupBy("a").agg(F.max(F.struct("score", "b")).alias("best")).select("a", "best.b")
    for turn in (best, pairs.where(at_threshold), pairs.where(~at_threshold)):
        known = turn.select("a", "b")
        for side in ("a", "b"):
            known = known.join(
                roots.select("node", F.col("root").alias(f"{side}_root")), F.col(side) == F.col("node")
            ).drop("node")
        apart = saved(known.where(F.col("a_root") != F.col("b_root")), f"{label}-apart")
        linked = linker.confirmed(apart.select("a", "b", "a_root", "b_root"))
        links = saved(linked.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), f"{label}-links")
        if links.isEmpty():
            continue
        step = components(links, label).select(F.col("node").alias("root"), F.col("root").alias("further"))
        roots = saved(
            roots.join(step, "root", "left").select("node", F.coalesce("further", "root").alias("root")),
            f"{label}-joined",
        )
    return roots


def _rest_pairs(members: DataFrame, classes: DataFrame, roots: DataFrame, linker: _Linker) -> DataFrame:
    """(a, b, score): likely pairs that share a bucket and not a component, hubs left out.

    In each bucket the classes outside its largest component meet all classes of other
    components there. A bucket is dealt into cells of about ``CELL`` by ``CELL`` classes, and a
    pair counts in the first bucket it shares. These classes get a second signature of
    ``FINE`` functions, so that few pairs below the threshold are left to confirm.
    """
    placed = saved(
        members.join(roots.withColumnRenamed("node", "set_id"), "set_id").select("bucket", "set_id", "hub", "root"),
        "placed",
    )
    by_root = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    buckets = saved(
        by_root.groupBy("bucket")
        .agg(
            F.sum("n").alias("n"),
            F.max(F.struct("n", "root")).alias("body"),
            F.count(F.lit(1)).alias("n_roots"),
        )
        .where((F.col("n_roots") > 1) & (F.col("n") > 2))
        .select(
            "bucket",
            F.col("body.root").alias("body"),
            F.ceil(F.col("n") / CELL).cast("int").alias("n_y"),
            F.ceil((F.col("n") - F.col("body.n")) / CELL).cast("int").alias("n_x"),
        ),
        "open-buckets",
    )
    fields = ["n", *[f"w{i}" for i in range(WORDS)], "bands", "fine"]
    opened = saved(placed.join(buckets, "bucket"), "open-places")
    fine = saved(
        linker.sets.join(opened.select("set_id").distinct(), "set_id", "left_semi").select(
            "set_id", _fine_signature("shingles").alias("fine")
        ),
        "fine-signatures",
    )
    own = classes.select("set_id", *fields[:-1]).join(fine, "set_id")
    known = saved(opened.join(own, "set_id"), "open-members")
    rest = known.where(F.col("root") != F.col("body")).select(
        "bucket",
        F.pmod(F.xxhash64("set_id"), "n_x").cast("int").alias("x_cell"),
        F.explode(F.sequence(F.lit(0), F.col("n_y") - 1)).alias("y_cell"),
        "hub",
        F.col("body").alias("x_body"),
        *[F.col(c).alias(f"x_{c}") for c in ("set_id", "root", *fields)],
    )
    others = known.select(
        "bucket",
        F.pmod(F.xxhash64("set_id"), "n_y").cast("int").alias("y_cell"),
        F.explode(F.sequence(F.lit(0), F.col("n_x") - 1)).alias("x_cell"),
        *[F.col(c).alias(f"y_{c}") for c in ("set_id", "root", *fields)],
    )
    sides = [{f: F.col(f"{s}_{f}") for f in fields} for s in ("x", "y")]
    first_shared = F.element_at(
        F.filter(F.arrays_zip("x_bands", "y_bands"), lambda p: p["x_bands"] == p["y_bands"]), 1
    )["x_bands"]
    both_rest = F.col("y_root") != F.col("x_body")
    likeness = _fine_estimate(sides[0]["fine"], sides[1]["fine"])
    return rest.join(
        others,
        (rest["bucket"] == others["bucket"])
        & (rest["x_cell"] == others["x_cell"])
        & (rest["y_cell"] == others["y_cell"])
        & (F.col("x_root") != F.col("y_root"))
        & (~both_rest | (F.col("x_set_id") < F.col("y_set_id")))
        & (F.col("hub") != F.col("x_set_id"))
        & (F.col("hub") != F.col("y_set_id"))
        & linker.likely(*sides)
        & (likeness >= _bound(linker.percent / 100, FINE))
        & (first_shared == rest["bucket"]),
    ).select(F.col("x_set_id").alias("a"), F.col("y_set_id").alias("b"), likeness.alias("score"))


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(key, n_shingles, component_id, kept, id_hash, version) for each row.

    Documents whose shingle sets have 100 * intersection >= percent * union are linked;
    component_id is the smallest id that links reach, and kept tells that it is the row's own.
    Texts that are null, empty or without a word have n_shingles 0 and stand alone. A null id
    is passed over when the smallest is sought, and kept only where there is no other. Rows
    with the representative's id are all kept. ``id_hash`` and ``version`` are hashes of the id and
    the text. An empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    source = docs.select(
        F.col(f"`{key}`").alias("doc"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    ).withColumns({"id_hash": F.xxhash64("doc"), "version": F.xxhash64("text")})
    rows = saved(
        signatures(source, width).select("doc", "id_hash", "version", "m.*").select(
            "doc", "id_hash", "version", "set_id", F.col("n").cast("bigint").alias("n"), "bands",
            *[F.get("packed", F.lit(i)).alias(f"w{i}") for i in range(WORDS)],
        ),
        "signatures",
    )
    words = [f"w{i}" for i in range(WORDS)]
    classes = saved(
        rows.where(F.col("n") > 0)
        .groupBy("set_id")
        .agg(
            F.min(F.struct("id_hash", "version")).alias("example"),
            *[F.first(c).alias(c) for c in ("n", *words, "bands")],
        ),
        "set-classes",
    )
    spread = classes.select("set_id", F.explode("bands").alias("bucket"))
    shared = saved(
        spread.groupBy("bucket")
        .agg(F.min("set_id").alias("hub"), F.max("set_id").alias("last"))
        .where(F.col("hub") != F.col("last"))
        .select("bucket", "hub"),
        "shared-buckets",
    )
    members = saved(spread.join(shared, "bucket"), "bucket-members")
    hub_pairs = (
        members.where(F.col("set_id") != F.col("hub"))
        .select(F.col("set_id").alias("a"), F.col("hub").alias("b"))
        .distinct()
    )
    linker = _Linker(classes, _sets_of(source, classes, members, width), percent)
    roots = saved(members.select(F.col("set_id").alias("node"), F.col("set_id").alias("root")).distinct(), "roots")
    roots = _joined_roots(roots, linker.estimated(hub_pairs), linker, "hub")
    roots = _joined_roots(roots, _rest_pairs(members, classes, roots, linker), linker, "rest")
    labelled = saved(
        rows.where(F.col("n") > 0)
        .select("doc", "id_hash", "version", "set_id", "n")
        .join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
        .select("doc", "id_hash", "version", "n", F.coalesce("root", "set_id").alias("root")),
        "labelled",
    )
    smallest = saved(labelled.groupBy("root").agg(F.min("doc").alias("component_id")), "smallest")
    found = labelled.join(smallest, "root").select("doc", "n", "component_id", "id_hash", "version")
    alone = rows.where(F.col("n") == 0).select("doc", "n", F.col("doc").alias("component_id"), "id_hash", "version")
    return found.unionByName(alone).select(
        F.col("doc").alias(key),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"),
        "id_hash",
        "version",
    )


def _sets_of(source: DataFrame, classes: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """(set_id, shingles): the full sets of the classes that share a bucket, from one text each."""
    needed = classes.join(members.select("set_id").distinct(), "set_id", "left_semi").select(
        "set_id", "example.id_hash", "example.version"
    )

    @F.pandas_udf("binary")
    def full(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, width).tobytes() for t in texts], dtype=object)

    return saved(
        source.select("id_hash", "version", "text")
        .join(needed.hint("shuffle_hash"), ["id_hash", "version"])
        .dropDuplicates(["id_hash", "version"])
        .select("set_id", full("text").alias("shingles")),
        "shingle-sets",
    )
