import unicodedata
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.config import CleaningConfig
from corpusmill.functions import cleaning, gates
from corpusmill.functions.text import strip, two_decimals
from corpusmill.plans.processing import clean_aligned, clean_texts

GOOD = "The mill by the river grinds barley in autumn and rye in spring."


def one(spark, text, step):
    return spark.createDataFrame([(text,)], "t string").select(step(F.col("t"))).first()[0]


def test_signature_is_cut(spark):
    text = "The barley is milled.\nBest regards,\nthe miller"
    assert one(spark, text, cleaning.remove_boilerplate) == "The barley is milled."


def test_boilerplate_inside_words(spark):
    assert one(spark, "privately Confidential", cleaning.drop_boilerplate_words) == "ly "


def test_format(spark):
    text = "sacks   of    rye\n\n\n\nand  of oats"
    expected = "sacks of rye\n\nand of oats"
    assert one(spark, text, cleaning.standardize_format) == expected
    off = CleaningConfig(fix_spacing=False)
    assert one(spark, f"  {text} ", lambda t: cleaning.standardize_format(t, off)) == text


def test_quotes_and_control_characters(spark):
    assert one(spark, "“a” ‘b’", cleaning.straighten_quotes) == "\"a\" 'b'"
    assert one(spark, "rye\n\noats\t", cleaning.remove_control_chars) == "ryeoats"
    spaced = CleaningConfig(control_replacement=" ")
    assert one(spark, "a\nb", lambda t: cleaning.clean_special_chars(t, spaced)) == "a b"


def test_urls_are_dropped_on_request(spark):
    config = CleaningConfig(remove_urls=True)
    assert one(spark, "see https://a.b/c?d now", lambda t: cleaning.clean(t, config)) == "see now"


def test_gates(spark):
    rows = spark.createDataFrame(
        [(GOOD,), ("one sack",), (None,), ("",), ("averyverylongsingleword indeed",)], "t string"
    )
    passed = rows.select(gates.quality_ok(F.col("t"), F.lit(False)).alias("ok")).collect()
    assert [r.ok for r in passed] == [True, False, False, False, False]


def test_long_text_without_entity_is_rejected(spark):
    words = " ".join(["word"] * 60)
    rows = spark.createDataFrame([(words,), (words + " Microsoft",)], "t string")
    kept = clean_texts(rows, "t").collect()
    assert [r.t for r in kept] == [words + " Microsoft"]


def test_batch_and_aligned(spark):
    texts = ["Forty sacks went to town", "one sack", None, "The wheel stood still for a week"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert clean_texts(rows, "t").count() == 2
    aligned = {r.i: r.t_cleaned for r in clean_aligned(rows, "t").collect()}
    assert aligned == {0: texts[0], 1: "", 2: "", 3: texts[3]}


# Cleaned by hand. Control characters go and glue what they part.
BY_HAND = [
    ("  plain  words\there ", "plain words here"),
    ("first\n\n\n\nsecond", "firstsecond"),
    ("Copyright 2020 by us", "2020 by us"),
    ("say it\nBEST REGARDS\nall of us", "say it"),
    ("“so” ‘it’ goes", "\"so\" 'it' goes"),
    ("a\x0bb\x85c", "a b c"),
    ("zero\u200bwidth", "zerowidth"),
    ("", ""),
]


def test_clean_by_hand(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(BY_HAND)], "i int, t string")
    got = {r.i: r.c for r in rows.select("i", cleaning.clean(F.col("t")).alias("c")).collect()}
    assert got == {i: c for i, (_, c) in enumerate(BY_HAND)}


# Letters, blanks of all kinds, marks and formulas; code points that Java knows too.
ATOMS = st.sampled_from(
    list("aB é.,“‘\n\t\r\x0b\x1c\x85\xa0\u200b\ufeff\u3000 ") + ["private", "Best Regards", "©", "😀"]
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(ATOMS, max_size=40).map("".join), min_size=1, max_size=40))
def test_properties_of_cleaned_texts(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = rows.select(
        "i", cleaning.clean(F.col("t")).alias("c"), strip(F.col("t")).alias("s"), gates.word_count(F.col("t")).alias("n")
    ).collect()
    for r in found:
        text = texts[r.i]
        assert r.s == text.strip() and r.n == len(text.split())
        assert not any(unicodedata.category(c).startswith("C") for c in r.c)
        assert not set(r.c) & set("“”‘’")
        assert "best regards" not in r.c.lower() and "private" not in r.c.lower()
        letters = Counter(c for c in text if c.isalnum())
        assert not Counter(c for c in r.c if c.isalnum()) - letters


def test_two_decimals_rounds_like_python(spark):
    values = [k / n for n in (8, 40, 200, 997, 1000) for k in range(n + 1)]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    for r in rows.select("x", two_decimals(F.col("x")).alias("s")).collect():
        assert r.s == f"{r.x:.2f}", r.x
