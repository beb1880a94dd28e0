"""What the plans must not do: shuffle for row-level work, pair all rows, read all columns."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusmill.config import AnnotationConfig
from corpusmill.operators import profile as pr
from corpusmill.operators import rules
from corpusmill.operators.annotate import annotate
from corpusmill.operators.language import LanguageModel
from corpusmill.plans.processing import clean_aligned, clean_texts, process_table
from corpusmill.sources.readers import spread

from test_queries import FOLDER, pytestmark  # noqa: F401


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_row_level_work_has_no_shuffle_and_reads_its_columns(spark, docs):
    model = LanguageModel.train(docs, "text", "lang")
    few = docs.select("doc_id", "text")
    for df in (
        clean_aligned(few, "text"),
        clean_texts(few, "text"),
        process_table(few, ["text"]),
        annotate(few, "text", AnnotationConfig(enable_keywords=False), language_model=model),
        model.detect(few, "text"),
        rules.SpecialCharacterRule().issues(few, "doc_id"),
    ):
        text = plan(df)
        assert "Exchange" not in text
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_expensive_columns_are_computed_once(docs):
    kept = clean_texts(docs.select("doc_id", "text"), "text")
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("confidential") == 1


def test_outliers_read_numbers_only(docs):
    text = plan(pr.outliers(docs))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in text and "text:string" not in text


def test_filters_reach_the_scan(docs):
    text = plan(clean_aligned(docs.where(F.col("source") == "src7"), "text"))
    assert "EqualTo(source,src7)" in text


def test_examples_are_limited_before_the_shuffle(docs):
    text = plan(rules.DataFormatRule({"text": "^x$"}).examples(docs.select("doc_id", "text"), "doc_id"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_rows_are_dealt_out_on_request_only(docs):
    assert "Exchange" not in plan(spread(docs.coalesce(1), None))
    assert "RoundRobin" in plan(spread(docs.coalesce(1), 4))


@pytest.mark.parametrize(
    "name", ["batch_gate", "q_validate", "q_validate_by_source", "q_overall", "q_integrity", "ann_keywords"]
)
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
