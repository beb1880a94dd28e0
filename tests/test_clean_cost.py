"""Cleaning leaves alone what needs no change, with the results of the plain patterns."""

from itertools import product

from pyspark.sql import functions as F

from corpusmill.functions import cleaning
from corpusmill.functions import patterns as P


def test_single_blanks_are_passed_over(spark):
    df = spark.createDataFrame([("the mill grinds barley, and rye",), ("a  b \t c\td  e f",)], "t string")
    counts = [r[0] for r in df.select(F.regexp_count("t", F.lit(P.SPACE_RUN))).collect()]
    assert counts == [0, 5]


def test_spacing_equals_the_plain_pattern(spark):
    parts = ["", " ", "  ", "\t", "\n", " ", " ", "x", "é", "~"]
    texts = [("".join(p),) for n in (1, 2, 3, 4) for p in product(parts[1:], repeat=n)] + [("",), (None,)]
    df = spark.createDataFrame(texts, "t string")
    plain = F.regexp_replace("t", rf"[{P.WS_NOT_NEWLINE}]+", " ")
    differ = df.where(~F.regexp_replace("t", P.SPACE_RUN, " ").eqNullSafe(plain))
    assert differ.count() == 0


def test_quotes_equal_translation(spark):
    texts = [("“a” ‘b’",), ("plain",), ("low ‚ and „ stay",), ("",), (None,), ("‘",), ("‛”",)]
    df = spark.createDataFrame(texts, "t string")
    plain = F.translate("t", "“”‘’", "\"\"''")
    assert df.where(~cleaning.straighten_quotes(F.col("t")).eqNullSafe(plain)).count() == 0
