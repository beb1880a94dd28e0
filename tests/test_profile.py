import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.config import QualityConfig
from corpusmill.operators import profile as pr
from corpusmill.operators.batch_gate import batch_gate, gate_scores
from corpusmill.operators.integrity import integrity, orphans

near = lambda x: pytest.approx(x, abs=1e-6)


@pytest.fixture(scope="module")
def sample(spark):
    rows = [
        ("Good quality text", 1, "valid@email.com", "2024-01-01"),
        ("Another good example", 2, "invalid-email", "2024-01-02"),
        (None, 3, "another@email.com", "2024-01-03"),
        ("Short", 4, None, "2024-01-04"),
        ("Text with special chars @#$%", 1000, "test@test.com", "invalid-date"),
    ]
    return spark.createDataFrame(rows, "text string, number int, email string, date string")


def empty(spark):
    return spark.createDataFrame([], T.StructType([]))


def test_sample_profile(sample):
    row = pr.validate(sample).first()
    assert row.completeness == near(0.9)
    assert row.consistency == near(0.745610)
    assert row.validity == near(0.85)
    assert row.uniqueness == near(0.96)
    assert row.timeliness == row.integrity == 1.0
    assert row.accuracy == near(0.9875)
    assert row.overall_score == near(0.912092)
    assert row.passed and row.issues == []


def test_single_dimensions_equal_the_profile(sample):
    row = pr.profile(sample).first()
    assert pr.completeness(sample).first()[0] == near(row.completeness)
    assert pr.consistency(sample).first()[0] == near(row.consistency)
    assert pr.validity(sample).first()[0] == near(row.validity)
    assert pr.uniqueness(sample).first().uniqueness == near(row.uniqueness)
    assert pr.accuracy(sample).first()[0] == near(row.accuracy)


def test_empty_frames(spark):
    no_columns = pr.validate(empty(spark)).first()
    no_rows = pr.validate(spark.createDataFrame([], "a int, b string")).first()
    for row in (no_columns, no_rows):
        assert row.timeliness == 1.0 and row.overall_score == near(0.1)
        assert not row.passed and len(row.issues) == 2
        assert row.completeness == row.uniqueness == row.accuracy == row.integrity == 0.0


def test_one_column_and_all_null(spark):
    one = pr.validate(spark.createDataFrame([(1,), (2,), (3,)], "col1 int")).first()
    assert one.overall_score == near(1.0) and one.passed
    nulls = spark.createDataFrame([(None, None)] * 2, "col1 string, col2 string")
    row = pr.validate(nulls).first()
    assert (row.completeness, row.consistency, row.validity) == (0.0, 1.0, 0.0)
    assert row.uniqueness == near(0.35) and row.accuracy == 0.0
    assert row.overall_score == near(0.4525)
    assert row.issues == ["Completeness score 0.00 below threshold 0.8"]


def test_consistency_of_equal_lengths_and_of_one_value(spark):
    same = spark.createDataFrame([("abc",), ("def",), ("ghi",)], "text string")
    assert pr.consistency(same).first()[0] == 1.0
    single = spark.createDataFrame([("abc",)], "text string")
    assert pr.consistency(single).first()[0] == 0.0


def test_duplicates(spark):
    rows = spark.createDataFrame([("same",), ("same",), ("different",)], "text string")
    assert pr.uniqueness(rows).first().uniqueness == near(2 / 3)


def test_nulls_take_part_in_row_identity(spark):
    rows = spark.createDataFrame(
        [(None, "a"), ("a", None), (None, "a"), ("aa", ""), ("a", "a")], "x string, y string"
    )
    assert pr.uniqueness(rows).first().row_uniqueness == near(4 / 5)


def test_nan_is_missing(spark):
    rows = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (4.0,)], "x double")
    assert pr.completeness(rows).first()[0] == 0.5
    assert pr.outliers(rows).first().outlier_share == 0.0


def test_timeliness(spark):
    end = dt.datetime(2024, 1, 31)
    rows = [(end - dt.timedelta(days=d),) for d in (10, 7.5, 5, 2.5, 0)]
    frame = spark.createDataFrame(rows, "timestamp timestamp")
    assert pr.timeliness(frame, "timestamp", "2024-01-31 00:00:00").first()[0] == near(0.833333)
    assert pr.timeliness(frame, "missing").first()[0] == 1.0
    texts = spark.createDataFrame([("2024-01-21",), ("2024/01/21",), ("what",)], "t string")
    assert pr.timeliness(texts, "t", "2024-01-31").first()[0] == near(2 / 3)


def test_outliers(spark):
    rows = spark.createDataFrame([(float(i % 10),) for i in range(99)] + [(1e6,)], "x double")
    assert pr.outliers(rows).first().outlier_share == near(0.01)
    constant = spark.createDataFrame([(5,)] * 20, "x int")
    assert pr.outliers(constant).first().outlier_share == 0.0


def test_profile_by_group_equals_profiles_of_the_groups(spark):
    rows = [("hot" if i % 3 else f"g{i}", i * 7 % 23, "text " * (i % 5)) for i in range(60)]
    rows.append((None, 1, "lonely"))
    frame = spark.createDataFrame(rows, "g string, x int, t string")
    grouped = {r.g: r for r in pr.profile(frame, by=("g",)).collect()}
    assert len(grouped) == frame.select("g").distinct().count()
    for name in ("hot", "g0", None):
        single = pr.profile(frame.where(F.col("g").eqNullSafe(name)).drop("g")).first()
        for dimension in (*pr.QUALITY_DIMENSIONS, "overall_score"):
            assert grouped[name][dimension] == near(single[dimension]), (name, dimension)


def test_strict_checks_all_thresholds(sample):
    issues = pr.validate(sample, QualityConfig(min_validity=0.9, strict=True)).first().issues
    assert issues == ["Validity score 0.85 below threshold 0.9"]


def test_approximate_distinct_needs_no_digest_shuffle(sample):
    row = pr.profile(sample, QualityConfig(approximate_distinct=True)).first()
    assert row.uniqueness == pytest.approx(0.96, abs=0.05)


def test_config_overlays_defaults():
    config = QualityConfig.from_dict({"min_completeness": 0.5, "unknown": 1})
    assert config.min_completeness == 0.5 and config.min_consistency == 0.7


def test_integrity_with_a_hot_key(spark):
    child = spark.createDataFrame([(1,)] * 50 + [(2,)] * 30 + [(9,)] * 20 + [(None,)], "p_id int")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    share = integrity(child, {"p_id": (parent, "id")}).first()
    assert share.found_share == near(0.8)
    assert [tuple(r) for r in orphans(child, "p_id", parent, "id").collect()] == [(9, 20)]
    assert pr.profile(child, references={"p_id": (parent, "id")}).first().integrity == near(0.8)
    assert pr.profile(child).first().integrity == 1.0


def test_gate_scores(spark):
    nulls = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (4, "d")], "A int, B string")
    assert gate_scores(nulls).first().completeness == 0.875
    good = spark.createDataFrame([("good text 1", "A"), ("good text 2", "B")], "text string, label string")
    assert tuple(gate_scores(good).first()) == (1.0,) * 5
    assert batch_gate(good).count() == 2
    bad = spark.createDataFrame([("a", None), ("a", None), ("a" * 99, None)], "t string, l string")
    assert batch_gate(bad).count() == 0 and batch_gate(bad, -9.0).count() == 3
    # One row has no deviation: the score is unknown, the gate stays shut.
    assert batch_gate(spark.createDataFrame([("x",)], "t string")).count() == 0


def test_sketches_unite(spark):
    from corpusmill.operators import sketches

    rows = [(f"day{i % 4}", f"text {i % 3000}", None if i % 2 else "same", i) for i in range(12_000)]
    df = spark.createDataFrame(rows, "day string, t string, u string, n int")
    parts = sketches.text_sketches(df, ("day",))
    assert parts.count() == 8 and parts.columns == ["day", "column", "n_rows", "n_values", "sketch"]
    found = {r["column"]: r for r in sketches.estimated_uniqueness(sketches.united(sketches.united(parts, ("day",)))).collect()}
    assert found["t"].n_rows == 12_000 and abs(found["t"].distinct_values - 3000) <= sketches.ERROR * 3000
    assert (found["u"].n_values, found["u"].distinct_values) == (6000, 1)
    assert sketches.text_sketches(df.select("n")).count() == 0
    empty = sketches.estimated_uniqueness(sketches.text_sketches(df.limit(0))).collect()
    assert {(r["column"], r.distinct_values, r.uniqueness) for r in empty} == {("day", 0, 0.0), ("t", 0, 0.0), ("u", 0, 0.0)}


def test_values_that_are_no_time_are_counted(spark):
    df = spark.createDataFrame([("2024-01-01", "a"), ("01/02/2024", "a"), ("soon", "a"), (None, "b"), ("", "b")], "t string, g string")
    assert {tuple(r) for r in pr.unreadable_times(df, "t", ("g",)).collect()} == {("a", 3, 1), ("b", 1, 1)}
    times = df.select(F.to_date(F.lit("2024-01-01")).alias("t"))
    assert tuple(pr.unreadable_times(times, "t").first()) == (5, 0)
