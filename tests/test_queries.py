"""Every query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def in_order(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in places]) for row in rows)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cursor = duck.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert in_order(df.columns, rows) == in_order(columns, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_json_documents_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    import json

    from corpusmill.catalog import queries

    # The same row again and again, as one very common conversation gives them.
    rows = [(c, 0, "user", f"text {c}") for c in (0, 1, 2) for _ in range(3000)]
    talks = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    talks.write.parquet(f"{tmp_path}/in/conversations.parquet")
    monkeypatch.setattr(queries, "ROWS_PER_DOCUMENT", 50)
    queries._write_json_files(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    found = [len(json.loads(r[0])["text"]) for r in spark.read.text(f"{tmp_path}/out/columns.json").collect()]
    assert sum(found) == 3000 and len(found) >= 50 and max(found) < 150
    arrays = spark.read.text(f"{tmp_path}/out/array.json").collect()
    assert sum(r[0] == "[" for r in arrays) >= 50 and sum(r[0].startswith("{") for r in arrays) == 3000
    assert queries.src_json_scan(spark, f"{tmp_path}/in").count() == 9000
