from corpusmill.llm.decontaminate import contaminated

from .cases import awkward_docs, empty_docs, sentence

QUESTION = (
    "A farmer called Peter has 12 apples and gives 5 kg of them to Anna, so that Peter keeps what is left of the 12 apples in a box."
)


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def items_of(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id bigint, text string")


def found(docs, items, **more):
    return sorted((r["doc_id"], r["item_id"], r["changed"]) for r in contaminated(docs, items, **more).collect())


def test_exact_and_asked_again(spark):
    again = QUESTION.replace("Peter", "Mary Ann").replace("12", "30").replace("5 kg", "9 lb").replace("Anna", "Tom")
    broken = again.replace("of the 30", "of the 31")
    docs = docs_of(
        spark, "So it goes. " + QUESTION + " End.", "Hm, " + again, "Hm, " + broken, "A farmer called on us.", QUESTION.upper()
    )
    got = found(docs, items_of(spark, (7, QUESTION)))
    assert (0, 7, False) in got and (1, 7, True) in got
    assert not {r[0] for r in got} & {2, 3}


def test_part_of_an_item(spark):
    import random

    rng = random.Random(4)
    item, other = sentence(rng, 40), sentence(rng, 40)
    half, few = " ".join(item.split()[:22]), " ".join(item.split()[:10])
    docs = docs_of(spark, f"{other}. {half}. {other}", f"{other}. {few}. {other}", other)
    assert found(docs, items_of(spark, (1, item))) == [(0, 1, False)]
    assert found(docs, items_of(spark, (1, item)), min_share=0.01) == [(0, 1, False), (1, 1, False)]


def test_short_items(spark):
    docs = docs_of(spark, "we saw that seven purple owls sing loudly in there", "seven purple owls")
    items = items_of(spark, (1, "Seven purple owls sing loudly"), (2, "purple owls"), (3, None), (4, ""), (None, "owls sing loudly in there"))
    rows = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()}
    assert rows == {(0, 1), (0, None)}


def test_awkward_rows(spark):
    items = items_of(spark, (1, "lomi tenra souvi derpa nique stoka ka lo mi"), (1, "lomi tenra souvi derpa nique stoka ka lo mi"))
    assert contaminated(awkward_docs(spark), items).count() == 0
    one = awkward_docs(spark).where("doc_id = 3").first()["text"]
    hits = contaminated(awkward_docs(spark), items_of(spark, (9, one))).collect()
    assert [(r["doc_id"], r["n_shared"] == r["n_windows"]) for r in hits] == [(3, True)]
    assert contaminated(empty_docs(spark), items).count() == 0
    assert contaminated(awkward_docs(spark), items.limit(0)).count() == 0


def test_many_windows_are_joined_by_shuffle(spark, monkeypatch):
    from corpusmill.llm import decontaminate

    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WINDOWS", 0)
    test_exact_and_asked_again(spark)


def test_verbatim_with_one_of_two_equal_fillers_altered(spark):
    item = (
        "Each of the 12 baskets on the long wooden table by the window of the old kitchen holds ripe fruit, "
        "and each of the 12 baskets weighs as much as the one that stands next to it on the left side. How much is that in all?"
    )
    altered = item.replace("12 baskets weighs", "13 baskets weighs")
    other = altered.replace("12 baskets", "30 baskets")
    docs = docs_of(spark, f"Look. {altered} Yes.", f"Look. {other} Yes.", "Each of the 12 baskets weighs much.")
    assert {r[0] for r in found(docs, items_of(spark, (1, item)))} == {0, 1}


def test_letter_case_and_items_of_numbers(spark):
    sums = "Compute 12 + 15 - 7 * 3"
    rows = "Table: 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 and so on"
    names = "One day Peter met Anna and Paul met Mary, then Peter told Paul that Anna told Mary of Peter."
    texts = [QUESTION.upper(), QUESTION.lower(), f"So: {sums}. Well.", f"See {rows}.", names.upper(), names.lower(), "Compute 12 + 15 - 7 * 4"]
    items = items_of(spark, (1, QUESTION), (2, sums), (3, rows), (4, names))
    got = {r[:2] for r in found(docs_of(spark, *texts), items)}
    assert got == {(0, 1), (1, 1), (2, 2), (3, 3), (4, 4), (5, 4)}


def test_only_windows_that_can_match_are_counted(spark):
    from corpusmill.llm.decontaminate import benchmark_windows

    item = "Add up the following long list of values: " + " ".join(map(str, range(100, 140)))
    rows = benchmark_windows(items_of(spark, (1, item)), "item_id", "text").collect()
    for exact in (False, True):
        part = [r for r in rows if r["exact"] == exact]
        assert part and {r["n_windows"] for r in part} == {len(part)}


def test_names_at_the_beginning_of_sentences(spark):
    item = "Peter has 12 apples. Anna takes 5 of them away. How many apples does Peter have left in his basket?"
    again = "Mary has 30 apples. Tom takes 7 of them away. How many apples does Mary have left in his basket?"
    swapped = "Mary has 30 apples. Tom takes 7 of them away. How many apples does Tom have left in his basket?"
    plain = "Trees grow here. Rivers run by them away. Apples cost 3 coins and Mary likes apples."
    docs = docs_of(spark, f"So. {again} Well.", swapped, plain, item)
    got = found(docs, items_of(spark, (1, item)))
    assert (0, 1, True) in got and (3, 1, False) in got
    assert not {r[0] for r in got} & {2}
