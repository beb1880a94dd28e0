"""Near-duplicate documents by SimHash fingerprints, searched in Gray order.

A fingerprint's place in Gray order is the number whose Gray code it is: neighbours in that order
differ in few bits. Runs of neighbours become the leaves of a tree. A node keeps the bits that all
fingerprints below it share, as a mask and a pattern; bits that its own parent shares already are
factored out. Two subtrees descend together: the differences on bits that both nodes share add up
on the way down, and beyond ``distance`` both whole groups are dropped. So are groups that are known
to be connected.

Spark deals out the work. First each run of the Gray order (ranges, so no fingerprint is hot) links
its own codes, which shrinks groups of near copies. Then the 64 bits are cut into blocks, at least
``distance`` + 1 of them: two linked fingerprints agree in all but ``distance`` blocks. The blocks
that agree are the key to a bucket, and each bucket is searched by its own tree. The number
of blocks follows the number of fingerprints, so that buckets stay small. A bucket that is large all
the same is dealt into cells; what lies outside its largest component meets everything there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed_texts, saved, small_batches
from .minhash import components

FAN = 8
RUN = 4096  # codes of one local tree in Gray order
CELL = 1024  # codes of a bucket that one tree takes
BUCKET = 256  # expected codes of a bucket, beyond which more blocks are cut
_SHINGLES_AT_ONCE = 1 << 16
_PAIRS_AT_ONCE = 1 << 15
_ROWS_AT_ONCE = 1 << 16
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """The majority bits of the XXH64 of all shingles, repeats counted.

    Words are runs without ASCII white space, A-Z lower-cased. Fewer than ``width`` of them are one
    shingle; without any the fingerprint is 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.cumsum([0, *[len(w) + 1 for w in words]])
    width = min(width, len(words))
    n = len(words) - width + 1
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _SHINGLES_AT_ONCE):
        begin = starts[at : min(n, at + _SHINGLES_AT_ONCE)].tolist()
        end = (starts[at + width : at + width + len(begin)] - 1).tolist()
        hashes = np.array(
            [xxhash.xxh64_intdigest(joined[i:j], seed) for i, j in zip(begin, end, strict=True)], dtype="<u8"
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def gray_place(codes: np.ndarray) -> np.ndarray:
    """The number whose Gray code each code is."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def gray_order(code: Column) -> Column:
    """The same as a signed number that sorts as the unsigned one does."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


class GrayTree:
    """Codes in Gray order, by owner, below nodes of ``FAN`` children; owners share no node.

    ``codes`` must be sorted by owner and Gray place. Level 0 are the codes themselves.
    """

    def __init__(self, codes: np.ndarray, owners: np.ndarray):
        self.masks, self.patterns = [np.full(len(codes), _ONES)], [codes]
        self.children: list[tuple[np.ndarray, np.ndarray]] = [(np.arange(len(codes)), np.ones(len(codes), dtype=np.int64))]
        while True:
            n = len(owners)
            new = np.concatenate([[True], owners[1:] != owners[:-1]])
            within = np.arange(n) - np.flatnonzero(new)[np.cumsum(new) - 1]
            starts = np.flatnonzero(within % FAN == 0)
            every, some = np.bitwise_and.reduceat(self.patterns[-1], starts), np.bitwise_or.reduceat(self.patterns[-1], starts)
            mask = np.bitwise_and.reduceat(self.masks[-1], starts) & ~(every ^ some)
            self.masks.append(mask)
            self.patterns.append(every & mask)
            self.children.append((starts, np.diff(np.append(starts, n))))
            owners = owners[starts]
            if new[starts].all():
                break

    def _expanded(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs of a child of ``a`` and one of ``b``, each unordered pair once, and the pair they stem from."""
        (start, size) = self.children[level]
        many = size[a] * size[b]
        of = np.repeat(np.arange(len(a)), many)
        k = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        x, y = start[a[of]] + k // size[b[of]], start[b[of]] + k % size[b[of]]
        # Level 0 has no use for a code with itself, the levels above need a node with itself.
        once = (a[of] != b[of]) | (x < y if level == 1 else x <= y)
        return x[once], y[once], of[once]

    def connect(self, labels: np.ndarray, distance: int) -> np.ndarray:
        """For each label the smallest one it is connected to, over codes that differ in ``distance`` bits
        at most. ``labels`` holds a label, 0 and up, for each code; equal labels are connected."""
        root = np.arange(int(labels.max()) + 1)
        top = len(self.masks) - 1
        whole = self._whole(root[labels])
        stale = False
        done = 0
        ids = np.arange(len(self.masks[top]))
        stack = [(top, ids, ids, self.masks[top].copy(), np.zeros(len(ids), dtype=np.int64))]
        while stack:
            level, a, b, common, differ = stack.pop()
            if len(a) > _PAIRS_AT_ONCE:
                for part in (slice(_PAIRS_AT_ONCE, None), slice(0, _PAIRS_AT_ONCE)):
                    stack.append((level, a[part], b[part], common[part], differ[part]))
                continue
            if stale and done > len(labels):
                whole, stale, done = self._whole(root[labels]), False, 0
            one = (whole[level][a] >= 0) & (whole[level][a] == whole[level][b])
            if one.any():
                a, b, common, differ = a[~one], b[~one], common[~one], differ[~one]
            x, y, of = self._expanded(level, a, b)
            done += len(x)
            level -= 1
            masks, patterns = self.masks[level], self.patterns[level]
            both = masks[x] & masks[y]
            # Bits that the parents share were counted there.
            differ = differ[of] + np.bitwise_count((patterns[x] ^ patterns[y]) & both & ~common[of])
            near = differ <= distance
            x, y = x[near], y[near]
            if level:
                stack.append((level, x, y, both[near], differ[near]))
                continue
            p, q = labels[x], labels[y]
            while True:
                p, q = root[p], root[q]
                apart = p != q
                if not apart.any():
                    break
                p, q = p[apart], q[apart]
                np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
                while (root[root] != root).any():
                    root = root[root]
                stale = True
        return root

    def _whole(self, label: np.ndarray) -> list[np.ndarray]:
        """Per level and node the one label that all codes below have, or -1."""
        out = [label]
        for starts, _ in self.children[1:]:
            least, most = np.minimum.reduceat(out[-1], starts), np.maximum.reduceat(out[-1], starts)
            out.append(np.where(least == most, least, -1))
        return out


def tree_links(codes: np.ndarray, owners: np.ndarray, names: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(name, smaller name) of groups that a search inside each owner connects. ``names`` holds what each code
    belongs to already. There are at most as many as codes."""
    order = np.lexsort((gray_place(codes), owners))
    known, labels = np.unique(names[order], return_inverse=True)
    root = GrayTree(codes[order], owners[order]).connect(labels, distance)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return known[moved], known[root[moved]]


def _link_stream(batches: Iterator[pd.DataFrame], distance: int) -> Iterator[pd.DataFrame]:
    """Rows (cell, code, name) come sorted by cell; a cell that a batch cuts waits for the rest."""
    held: list[pd.DataFrame] = []
    rows = 0

    def searched(part: pd.DataFrame) -> pd.DataFrame:
        codes, cells, names = (part[c].to_numpy() for c in ("code", "cell", "name"))
        a, b = tree_links(codes.astype(np.int64).view(np.uint64), cells, names, distance)
        return pd.DataFrame({"a": a, "b": b})

    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows < _ROWS_AT_ONCE:
            continue
        part = pd.concat(held, ignore_index=True)
        cells = part["cell"].to_numpy()
        cut = int(np.searchsorted(cells, cells[-1], side="left"))
        if cut:
            yield searched(part.iloc[:cut])
        held = [part.iloc[cut:]]
        rows = len(part) - cut
    if rows:
        yield searched(pd.concat(held, ignore_index=True))


def _links(rows: DataFrame, distance: int) -> DataFrame:
    """(a, b): names that codes of one cell connect. Rows (cell, code, name) are dealt by cell."""
    return (
        rows.repartition("cell")
        .sortWithinPartitions("cell")
        .mapInPandas(lambda batches: _link_stream(batches, distance), "a bigint, b bigint")
        .distinct()
    )


def _run_links(codes: DataFrame, distance: int) -> DataFrame:
    """Links inside runs of ``RUN`` neighbours in Gray order; each task numbers the runs of its own range."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def numbered() -> Iterator[pd.DataFrame]:
            at = 0
            for batch in batches:
                yield batch.assign(name=batch["code"], cell=(at + np.arange(len(batch))) // RUN)
                at += len(batch)

        return _link_stream(numbered(), distance)

    place = gray_order(F.col("code"))
    return codes.select("code").repartitionByRange(place).sortWithinPartitions(place).mapInPandas(search, "a bigint, b bigint")


def block_masks(n: int, distance: int) -> list[int]:
    """The masks of the bits by which ``n`` codes go to buckets, as signed numbers.

    64 bits are cut into blocks, and each choice of all but ``distance`` blocks is a mask: two codes that
    differ in ``distance`` bits at most agree on one of them. There is one block more for
    as long as a bucket would hold over ``BUCKET`` random codes.
    """
    blocks = distance + 1
    while blocks < 64 and n >> (64 * (blocks - distance) // blocks) > BUCKET and comb(blocks + 1, distance) <= 1000:
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    bits = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(bits, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _bucket_links(codes: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """Links between components (``name``) of codes that share a bucket.

    Buckets that hold one component are left out. In one of over ``CELL`` codes, those outside its
    largest component are dealt into cells of about ``CELL``, and so is the whole bucket; each
    cell of the first kind meets each of the second.
    """
    placed = codes.select(
        "code", "name", F.posexplode(F.array(*[F.col("code").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "bits")
    )
    bucket = ["mask", "bits"]
    opened = saved(
        placed.groupBy(*bucket)
        .agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("least"), F.max("name").alias("most"))
        .where(F.col("least") != F.col("most"))
        .select(*bucket, "n"),
        "open-buckets",
    )
    few = placed.join(opened.where(F.col("n") <= CELL), bucket).select(
        F.xxhash64(*bucket).alias("cell"), "code", "name"
    )
    large = saved(placed.join(opened.where(F.col("n") > CELL), bucket), "large-buckets")
    bodies = (
        large.groupBy(*bucket, "name")
        .agg(F.count(F.lit(1)).alias("own"), F.first("n").alias("n"))
        .groupBy(*bucket)
        .agg(F.max(F.struct("own", "name")).alias("body"), F.first("n").alias("n"))
        .select(
            *bucket,
            F.col("body.name").alias("body"),
            F.ceil((F.col("n") - F.col("body.own")) / CELL).cast("int").alias("n_x"),
            F.ceil(F.col("n") / CELL).cast("int").alias("n_y"),
        )
    )
    dealt = large.drop("n").join(bodies, bucket)

    def one_of(n: str) -> Column:
        return F.pmod(F.xxhash64("code", "mask", F.lit(n)), F.col(n)).cast("int")

    def all_of(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    rest = dealt.where(F.col("name") != F.col("body")).withColumn("x", one_of("n_x")).select("*", all_of("n_y").alias("y"))
    whole = dealt.withColumn("y", one_of("n_y")).select("*", all_of("n_x").alias("x"))
    cells = [part.select(F.xxhash64(*bucket, "x", "y").alias("cell"), "code", "name") for part in (rest, whole)]
    return _links(few.union(cells[0]).union(cells[1]), distance)


def connected(codes: DataFrame, distance: int) -> DataFrame:
    """(code, root): distinct ``codes`` (bigint) with a number for the component that they are in
    by chains of codes that differ in ``distance`` bits at most. Exact, whatever the data."""
    small_batches(codes.sparkSession)
    codes = saved(codes.select("code"), "codes")
    near = components(saved(_run_links(codes, distance), "run-links"), "run")
    named_codes = saved(
        codes.join(near.withColumnRenamed("node", "code"), "code", "left").select("code", F.coalesce("root", "code").alias("name")),
        "named-codes",
    )
    links = saved(_bucket_links(named_codes, block_masks(codes.count(), distance), distance), "bucket-links")
    further = components(links, "bucket")
    return named_codes.join(further.withColumnRenamed("node", "name"), "name", "left").select(
        "code", F.coalesce("root", "name").alias("root")
    )


def simhash_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 4,
    distance: int = 4,
    seed: int = 42,
) -> DataFrame:
    """(key, fingerprint, component_id) for each row.

    Fingerprints link at ``distance`` or fewer differing bits; component_id is the smallest id that
    links reach. Null, empty and blank texts have the fingerprint 0 and link like any other. A null id
    is passed over when the smallest is sought, and the answer only where there is no other. Repeated
    rows give equal rows. A very long text is hashed in parts. Other columns are not read, so they cannot
    clash. An empty table gives an empty table.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("bigint")
    def of_text(texts: pd.Series) -> pd.Series:
        prints = np.fromiter((fingerprint(bytes(t), width, seed) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(prints.view(np.int64))

    rows = saved(
        keyed_texts(docs, key, text).select("doc", of_text(F.col("text").cast("binary")).alias("code")), "fingerprints"
    )
    classes = saved(rows.groupBy("code").agg(F.min("doc").alias("least")), "print-classes")
    rooted = saved(classes.join(connected(classes, distance), "code"), "rooted-prints")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = saved(rooted.join(smallest, "root").select("code", "component_id"), "print-components")
    return rows.join(found, "code").select(
        F.col("doc").alias(key), F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )
