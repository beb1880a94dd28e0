"""Offsets by running totals, against a plain loop."""

from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.text import running_totals, token_spans

@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 64, 1000, 5000])
def test_running_totals(spark, n):
    numbers = [i * 7 % 13 - 3 for i in range(n)]
    df = spark.createDataFrame([(numbers,), (None,)], "a array<int>")
    found = [r[0] for r in df.select(running_totals(F.col("a"))).collect()]
    assert found == [list(accumulate(numbers)), None]


def test_spans_of_a_long_text(spark):
    text = "Tide tables,  hours é. " * 3000
    spans = spark.createDataFrame([(text,)], "t string").select(token_spans(F.col("t"))).first()[0]
    assert [text[s.start : s.end] for s in spans] == [s.token for s in spans]
    assert len(spans) == 6 * 3000
