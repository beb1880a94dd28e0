import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.config import AnnotationConfig
from corpusmill.operators.annotate import annotate
from corpusmill.plans.processing import annotate_dataset, process_datasets
from corpusmill.plans.reports import analyze_dataset, quality_report, report_lines
from corpusmill.sources import readers, writers
from corpusmill.sources.listing import list_datasets
from corpusmill.streaming.rowwise import clean_stream, write_available


def test_csv_cells_and_types(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        'n,x,b,s,e,t\n1,1.5,True,"a ""q"" b",NA,"two\nlines"\nN/A,2,False,null,NA,1d\n-3,1e3,True,None,,x\n'
    )
    df = readers.read_dataset(spark, str(path))
    assert dict(df.dtypes) == {
        "n": "bigint", "x": "double", "b": "boolean", "s": "string", "e": "string", "t": "string"
    }
    rows = df.collect()
    assert [r.n for r in rows] == [1, None, -3] and [r.x for r in rows] == [1.5, 2.0, 1000.0]
    assert [r.s for r in rows] == ['a "q" b', None, None] and rows[0].t == "two\nlines"
    assert {r.e for r in rows} == {None}
    flat = tmp_path / "b.csv"
    flat.write_text("n,t\n1,x\n2,NA\n")
    rows = readers.read_dataset(spark, str(flat), multi_line=False).collect()
    assert [(r.n, r.t) for r in rows] == [(1, "x"), (2, None)]


def test_json_layouts(spark, tmp_path):
    records = [{"a": 1, "t": "x"}, {"a": 2, "t": None}]
    (tmp_path / "r.json").write_text(json.dumps(records, indent=1))
    (tmp_path / "c.json").write_text(json.dumps({"a": {"0": 1, "1": 2}, "t": {"0": "x", "1": None}}))
    (tmp_path / "l.jsonl").write_text("\n".join(json.dumps(r) for r in records))
    (tmp_path / "t.txt").write_text("x\ny\n")
    for name in ("r.json", "c.json", "l.jsonl"):
        rows = readers.read_dataset(spark, str(tmp_path / name)).orderBy("a").collect()
        assert [(r.a, r.t) for r in rows] == [(1, "x"), (2, None)], name
    assert readers.read_dataset(spark, str(tmp_path / "t.txt")).count() == 2
    with pytest.raises(readers.UnsupportedFormat):
        readers.read_dataset(spark, "x.xml")


@pytest.mark.parametrize("fmt", ["csv", "json", "jsonl", "parquet"])
def test_written_tables_come_back_whole(spark, tmp_path, fmt):
    rows = [(i, f"text {i}", f"2 lines\nof {i}" if i % 3 else "one") for i in range(23)] + [(23, "last", "x, \"y\"")]
    df = spark.createDataFrame(rows, "n bigint, t string, u string").repartition(3)
    path = str(tmp_path / f"d.{fmt}")
    writers.write_table(df, path, fmt)
    back = readers.read_dataset(spark, path).select("n", "t", "u")
    assert sorted(map(tuple, back.collect())) == rows


def test_json_documents_are_all_read(spark, tmp_path):
    (tmp_path / "d.json").mkdir()
    (tmp_path / "d.json" / "a.json").write_text('{"a": 1}\n{"a": 2}\n{"a": 3}\n')
    (tmp_path / "d.json" / "b.json").write_text('[{"a": 4},\n {"a": 5}]\n{\n"a": 6}\n')
    (tmp_path / "d.json" / "c.json").write_text('{"a": {"0": 7, "1": 8}}')
    (tmp_path / "e.json").write_text('{"a": {"0": 1}}\n{"a": {"0": 2, "1": 3}}\n')
    assert sorted(r.a for r in readers.read_dataset(spark, str(tmp_path / "d.json")).collect()) == list(range(1, 9))
    assert sorted(r.a for r in readers.read_dataset(spark, str(tmp_path / "e.json")).collect()) == [1, 2, 3]
    for bad in ('[{"a": 1}] tail', '[{"a": 1} {"a": 2}]', "17", '{"a": 1'):
        (tmp_path / "f.json").write_text(bad)
        with pytest.raises(Exception, match="malformed JSON"):
            readers.read_dataset(spark, str(tmp_path / "f.json")).collect()


def test_numbers_beyond_bigint_and_schemas(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,m,t\n1234567890123456789,12345678901234567890,NA\n1234567890123456788,1,x\n")
    df = readers.read_dataset(spark, str(tmp_path / "a.csv"))
    assert dict(df.dtypes) == {"k": "bigint", "m": "string", "t": "string"}
    assert sorted(r.k for r in df.collect()) == [1234567890123456788, 1234567890123456789]
    schema = T.StructType().add("k", "long").add("m", "string").add("t", "string")
    assert [r.t for r in readers.read_dataset(spark, str(tmp_path / "a.csv"), schema=schema).collect()] == [None, "x"]


def test_listing_below_a_folder_with_an_extension(spark, tmp_path):
    root = tmp_path / "dump.csv" / "raw"
    (root / "y").mkdir(parents=True)
    (root / "a.json").write_text("[]")
    (root / "y" / "b.csv").write_text("x\n1\n")
    found = {r.path.split("/raw", 1)[1] for r in list_datasets(spark, str(root)).collect()}
    assert found == {"/a.json", "/y/b.csv"}


def test_text_columns(spark):
    df = spark.createDataFrame(
        [("short", "a long enough text", None, 1), ("tiny", "another long text", None, 2)],
        "code string, body string, nothing string, n int",
    )
    assert readers.text_columns(df) == ["body"]


def test_listing(spark, tmp_path):
    for name in ("a.csv", "b.CSV", "c.txt", "d/e.jsonl", "d/.git/f.csv", "g.xml", "h.csv/part-0.csv", "h.csv/part-1.csv"):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text("x\n1\n")
    found = {
        r.path.split(str(tmp_path), 1)[1]: (r.extension, r.files)
        for r in list_datasets(spark, str(tmp_path)).collect()
    }
    assert found == {
        "/a.csv": ("csv", 1), "/c.txt": ("txt", 1), "/d/e.jsonl": ("jsonl", 1), "/h.csv": ("csv", 2)
    }


def test_processing_reports_each_dataset(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    (source / "x").mkdir(parents=True)
    long = "A good example text about Microsoft, long enough to be kept."
    (source / "x" / "docs.csv").write_text(f'id,body\n1,"{long}"\n2,too short\n3,NA\n4,"{long}"\n')
    (source / "docs.csv").write_text("id,code\n1,ab\n")
    (source / "bad.json").write_text("{oops")
    status = {r.dataset.rsplit("/in/", 1)[1]: r for r in process_datasets(spark, str(source), str(out)).collect()}
    assert status["x/docs.csv"].status == "done" and status["x/docs.csv"].text_columns == ["body"]
    assert status["docs.csv"].text_columns == []
    assert status["bad.json"].status == "failed" and status["bad.json"].error
    rows = spark.read.parquet(f"{out}/x/docs.csv/table").orderBy("id").collect()
    assert [r.body_cleaned for r in rows] == [long, "", "", long]
    assert [len(r.body_annotations) for r in rows] == [1, 0, 0, 1]
    assert [e.text for e in rows[0].body_annotations[0].entities] == ["Microsoft"]
    metrics = spark.read.json(f"{out}/x/docs.csv/metrics").first()
    assert metrics.column == "body" and metrics.completeness == pytest.approx(11 / 12)
    assert metrics.uniqueness == pytest.approx(3 / 4)


def test_nested_columns_in_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, [("a", 1)])], "id int, x array<struct<t:string,n:int>>")
    writers.write_table(df, str(tmp_path / "o.csv"), "csv")
    assert readers.read_csv(spark, str(tmp_path / "o.csv")).first().x == '[{"t":"a","n":1}]'


def test_report(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,t\n1,some longer text\n2,NA\n3,NA\n")
    report = analyze_dataset(spark, str(path), out=str(tmp_path / "report"), timestamp="T").first()
    assert not report.passed and report.issues == ["Completeness score 0.67 below threshold 0.8",
                                                   "Consistency score 0.00 below threshold 0.7"]
    assert report.dataset_stats.rows == 3 and report.dataset_stats.column_types == {"id": "bigint", "t": "string"}
    lines = [r.value for r in spark.read.text(str(tmp_path / "report" / "text")).collect()]
    assert lines[4] == "Overall Status: FAILED" and "- Completeness score 0.67 below threshold 0.8" in lines
    assert lines[-1].startswith("Memory Usage: ")
    good = spark.createDataFrame([("a fine text",), ("a good text",)], "t string")
    lines = [r.line for r in report_lines(quality_report(good, "d")).orderBy("line_no").collect()]
    assert "--- Issues Found ---" not in lines and lines[4] == "Overall Status: PASSED"


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"Example text number {i} that is long enough. Best regards, x") for i in range(20)] + [(99, "no")]
    spark.createDataFrame(rows, "id int, t string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, t string").parquet(str(tmp_path / "in"))
    write_available(clean_stream(stream, "t"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 20 and got.where(F.col("t").contains("regards")).count() == 0


def test_annotated_dataset_keeps_format_and_rows(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('n,t\n1,"Microsoft is good news"\n2,NA\n3,"other words here"\n')
    columns = annotate_dataset(spark, str(path), str(tmp_path / "annotated_a.csv"))
    assert columns == ["t"]
    rows = readers.read_csv(spark, str(tmp_path / "annotated_a.csv")).orderBy("n").collect()
    first = json.loads(rows[0].t_annotations)
    assert first["entities"][0]["text"] == "Microsoft" and rows[1].t_annotations is None
    assert {k["text"] for k in first["keywords"]} == {"Microsoft", "good", "news"}


def test_numbers_have_no_annotation(spark):
    df = annotate(spark.createDataFrame([(1, 5)], "id int, x int"), "x", AnnotationConfig())
    assert df.columns == ["id", "x", "x_annotations"] and df.first().x_annotations is None
