import hashlib
import random

from pyspark.sql import functions as F

from corpusmill.llm.fingerprint import combined, edited_fingerprints, fingerprint, likeness

from .cases import awkward_docs, awkward_rows, empty_docs


def prints(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["p"] for r in df.select("i", fingerprint(F.col("t")).alias("p")).orderBy("i").collect()]


def test_order_and_equality(spark):
    a, b, c, d, e = prints(spark, "x y\nz", "z\nx y", "x y z", "x y\nz\n", "x y\nz")
    assert a == b == e
    assert len({tuple(p) for p in (a, c, d)}) == 3


def test_paragraphs_come_and_go(spark):
    both, left, right, none = prints(spark, "a b c\nd e f", "a b c", "d e f", "")
    df = spark.createDataFrame([(both, left, right)], "both array<bigint>, one array<bigint>, other array<bigint>")
    row = df.select(
        combined(F.col("one"), F.col("other")).alias("sum"), combined(F.col("both"), F.col("other"), -1).alias("rest")
    ).first()
    assert row["sum"] == both
    assert row["rest"] == left
    assert none[2] == 0


def test_likeness(spark):
    words = [f"word{i}" for i in range(300)]
    text, half = " ".join(words), " ".join(words[:150] + [f"new{i}" for i in range(150)])
    a, b, c, e = prints(spark, text, half, " ".join(f"z{i}" for i in range(300)), "")
    df = spark.createDataFrame([(a, b, c, e)], "a array<bigint>, b array<bigint>, c array<bigint>, e array<bigint>")
    row = df.select(*[likeness(F.col("a"), F.col(x)).alias(f"to_{x}") for x in "abce"]).first()
    assert row["to_a"] == 1.0
    assert 0.3 < row["to_b"] < 0.75
    assert row["to_c"] < 0.3
    assert row["to_e"] == 0.0


def compared(spark, one, other):
    df = spark.createDataFrame([(one, other)], "a array<bigint>, b array<bigint>")
    return df.select(likeness(F.col("a"), F.col("b"))).first()[0]


def test_pieces_move_with_the_text(spark):
    """One word more in front, within or behind a paragraph of 600 words changes little."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(5000)}" for _ in range(600)]
    text, front, within, behind = prints(
        spark,
        " ".join(words),
        " ".join(["new", *words]),
        " ".join([*words[:300], "new", *words[300:]]),
        " ".join([*words, "new"]),
    )
    for other in (front, within, behind):
        assert compared(spark, text, other) > 0.9


def test_brute_force(spark):
    """The counters are the sums of the bits of each piece's hashes, told piece by piece."""
    text = "some words of a first paragraph that has several pieces\n\nand a second  one \nlast"
    (found,) = prints(spark, text)
    total = [0] * len(found)
    for paragraph in text.split("\n"):
        for at, x in enumerate(prints(spark, paragraph)[0]):
            total[at] += x
    assert [x % 2**62 for x in total] == found
    lanes = [(x & (2**31 - 1), x >> 31) for x in found[3:]]
    assert all(0 <= low <= found[2] and 0 <= high <= found[2] for low, high in lanes)


def test_counters_do_not_overflow(spark):
    (one,) = prints(spark, "\n".join(f"line {i}" for i in range(7)))
    many = [x * 2**24 % 2**62 for x in one]  # as often added to itself
    assert many[2] > 10_000_000
    assert compared(spark, one, many) > 0.999


def test_edited_texts(spark):
    rows = [r for r in awkward_rows() if r[0] is not None]
    docs = awkward_docs(spark).where("doc_id IS NOT NULL")
    found = {r["doc_id"]: r for r in edited_fingerprints(docs).collect()}
    ids = sorted({r[0] for r in rows})
    texts = {i: t or "" for i, t in rows}
    assert set(found) == set(ids)
    for i, after in zip(ids, ids[1:] + ids[:1]):
        n = len(texts[i]) // 4
        edited = texts[i][: len(texts[i]) - n] + texts[after][:n]
        assert found[i]["n_chars"] == len(texts[i])
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[i]["near_edited"] <= 1 and 0 <= found[i]["near_next"] <= 1
    assert found[0]["fingerprint"] == found[20]["fingerprint"]
    assert found[2]["near_edited"] > found[2]["near_next"]


def test_null_ids_and_repeated_rows(spark):
    assert edited_fingerprints(awkward_docs(spark)).count() == len(awkward_rows())


def test_one_row_and_none(spark):
    assert edited_fingerprints(empty_docs(spark)).count() == 0
    one = spark.createDataFrame([(5, "abcdefgh")], "doc_id bigint, text string")
    row = edited_fingerprints(one).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    assert row["near_next"] == 1.0
