import random
import zlib

import pytest

from corpusmill.llm.toxicity import Grams, score_documents

from .cases import awkward_docs, awkward_rows, empty_docs, sentence

INSULTS = ["grublok", "vrakish", "blorptard"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        words = sentence(rng, rng.randint(20, 120)).split()
        toxic = i % 5 == 1
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + rng.choice(["", "s", "en"]))
        rows.append((1000 + i, " ".join(words)))
        labels.append((1000 + i, 1, int(toxic)))
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        {i: t for i, _, t in labels},
    )


def test_held_out_accuracy(corpus):
    docs, labels, toxic = corpus
    rows = score_documents(docs, labels).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == (r["score"] >= 0.5)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == toxic[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_held_out_labels_change_nothing(spark, corpus):
    docs, labels, _ = corpus
    turned = labels.selectExpr(
        "doc_id", "quality", "if(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, 1 - toxic, toxic) AS toxic"
    )
    scores = [{r["doc_id"]: r["score"] for r in score_documents(docs, t).collect()} for t in (labels, turned)]
    assert scores[0] == pytest.approx(scores[1])


def test_awkward_rows(spark, corpus):
    docs, labels, _ = corpus
    awkward = awkward_docs(spark)
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, 1, None), (4, 1, 7)], labels.schema))
    both = awkward.unionByName(docs, allowMissingColumns=True)
    found = score_documents(both, odd)
    assert found.columns == [*awkward.columns, "held_out", "score_", "predicted"]
    rows = [r for r in found.collect() if r["doc"] == "d"]
    assert len(rows) == len(awkward_rows())
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"] or "", r["score_"]) == r["score_"]


def test_empty_tables_and_no_labels(spark, corpus):
    docs, labels, _ = corpus
    assert score_documents(empty_docs(spark), labels).count() == 0
    assert {r["predicted"] for r in score_documents(docs, labels.limit(0)).collect()} == {0}


def test_grams_end_at_each_character():
    grams = Grams(["ab", "abc"])
    third = grams.gram(3)
    assert list(grams.word) == [0, 0, 0, 1, 1, 1, 1]
    assert third[0] == third[3] and third[1] == third[4] and third[2] != third[5]


def test_corpus_counts_are_exact_whatever_the_partitions(spark):
    from corpusmill.llm.toxicity import _corpus_pairs

    rng = random.Random(3)
    letters = [chr(0x4E00 + i) for i in range(1500)]
    texts = [("".join(rng.choices(letters, k=600)),) for _ in range(1000)]
    want = {}
    for (t,) in texts:
        padded = [1, 1, *map(ord, t), 2]
        for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
            want.setdefault(b << 21 | c, set()).add(a)
    assert sum(map(len, want.values())) > 1 << 19
    docs = spark.createDataFrame(texts, "text string")
    for parts in (1, 4):
        found = {r["pair"]: r["n"] for r in _corpus_pairs(docs.repartition(parts)).collect()}
        assert found == {k: len(v) for k, v in want.items()}


def test_joined_and_broadcast_counts_score_alike(spark, corpus, monkeypatch):
    from corpusmill.llm import toxicity

    docs, labels, _ = corpus
    both = awkward_docs(spark).unionByName(docs, allowMissingColumns=True)
    scores = []
    for share in (toxicity.HOT_SHARE, 1e-2, 2.0):
        monkeypatch.setattr(toxicity, "HOT_SHARE", share)
        rows = score_documents(both, labels).collect()
        scores.append(sorted((str(r["doc_id"]), r["text"] or "", r["score_"]) for r in rows))
    for other in scores[1:]:
        assert [r[:2] for r in other] == [r[:2] for r in scores[0]]
        assert [r[2] for r in other] == pytest.approx([r[2] for r in scores[0]])


def test_ratios_against_a_plain_kneser_ney_model(spark):
    import math
    from collections import Counter, defaultdict

    from corpusmill.llm import toxicity

    rng = random.Random(11)
    texts = [" ".join("".join(rng.choices("abcde", k=rng.randint(1, 6))) for _ in range(30)) for _ in range(40)]
    texts += ["lomé naïve ab ab abab"] * 2
    labelled = [(i, t, int(i % 3 == 0), i * 7) for i, t in enumerate(texts)]

    def padded(word):
        return "\x01" * 4 + word + "\x02"

    def grams_of(words, order):  # of each padded word, those that end at a character or its end
        return [p[i - order + 1 : i + 1] for p in map(padded, words) for i in range(4, len(p))]

    def conditional(counts, lower):
        total, kinds = defaultdict(int), defaultdict(int)
        for gram, n in counts.items():
            total[gram[:-1]] += n
            kinds[gram[:-1]] += n > 0
        d = toxicity.DISCOUNT

        def p(gram):
            context = gram[:-1]
            if not total[context]:
                return lower(gram[1:])
            return max(counts[gram] - d, 0) / total[context] + d * kinds[context] / total[context] * lower(gram[1:])

        return p

    def preceded(longer):
        return Counter(g[1:] for g in set(longer))

    every = [w for t in texts for w in t.split()]
    pairs = preceded(grams_of(every, 3))
    singles = Counter(pair[1] for pair in pairs)
    kinds = sum(singles.values())
    spare = 1e-4 * toxicity.DISCOUNT * len(singles) / kinds
    shared = conditional(pairs, lambda c: max(singles[c] - toxicity.DISCOUNT, 0) / kinds + spare)
    models = []
    for label in (0, 1):
        words = [w for _, t, y, draw in labelled if y == label and _is_own(spark, draw) for w in t.split()]
        lower = shared
        for order in (3, 4, 5):
            raw = Counter(grams_of(words, order))
            counts = raw if order == 5 else preceded(grams_of(words, order + 1))
            counts = Counter({g: n for g, n in counts.items() if order == 5 or g[0] != "\x01"})
            counts.update({g: n for g, n in raw.items() if g[0] == "\x01" and order < 5})
            lower = conditional(counts, lower)
        models.append(lower)

    docs = spark.createDataFrame([r[:2] for r in labelled], "doc bigint, text string").repartition(3)
    labels = spark.createDataFrame([(r[3] // 7, r[2]) for r in labelled], "doc bigint, toxic int")
    handed, rare, _ = toxicity.fit(docs, labels)
    assert rare is None
    asked = [*dict.fromkeys(every), "zzz", "abz", "é"]
    want = [
        sum(math.log(max(models[1](g), 1e-9)) - math.log(max(models[0](g), 1e-9)) for g in grams_of([w], 5)) for w in asked
    ]
    assert list(handed.value.ratios(asked)) == pytest.approx(want, abs=1e-5)


def _is_own(spark, draw):
    """Whether the class models have the text: a fifth of the ids calibrates the weights."""
    return spark.range(1).selectExpr(f"pmod(xxhash64({draw // 7}L), 5) != 0 AS own").first()["own"]
