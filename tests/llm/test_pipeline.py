import os

import pytest

import corpus_pipeline
from corpusmill.llm.queries import QUERIES

from .cases import awkward_docs

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_take_awkward_rows(spark, tmp_path):
    docs = awkward_docs(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.columns == columns or name == "packing"
    assert docs.where("doc_id = 30").count() == 1


def test_kept_rows(spark):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, None), (4, "unlike the others, by far and wide"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5]
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first()["text"]
    docs = docs.union(spark.createDataFrame([(6, f"see {item} there")], docs.schema))
    left = corpus_pipeline.drop_contaminated(spark, docs, FOLDER)
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3, 4, 5]
