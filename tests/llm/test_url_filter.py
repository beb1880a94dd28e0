from pyspark.sql import functions as F

from corpusmill.llm.url_filter import (
    UrlRule, host_and_path, judge_urls, labelled_by_words, rule_of, train, with_features,
)

RULES = [UrlRule("block", "net", "/"), UrlRule("allow", "example.net", "/en/"), UrlRule("block", "example.com", "/de/")]
URLS = [
    "http://A.Example.NET/en/1?x=1#y", "https://example.net/fr/2", "http://net", "ftp://x.com?y://z/de/", "no scheme", None, "",
    "http://example.com/de/", "http://notexample.com/de/x", "https://sub.example.com/de/q?a=1&b=2", "a://b://c/d", "x" * 5000,
]


def pages(spark):
    rows = [(i, u, "h", "p") for i, u in enumerate([*URLS, URLS[0]])]
    return spark.createDataFrame(rows, "page_id bigint, url string, host string, p string")


def test_host_path_and_rules(spark):
    host, path = host_and_path(F.col("url"))
    rows = pages(spark).select("page_id", host.alias("h"), path.alias("q"), rule_of(host, path, RULES)["rule"].alias("r"))
    got = {r["page_id"]: (r["h"], r["q"], r["r"]) for r in rows.collect()}
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/")
    assert got[1] == ("example.net", "/fr/2", "net/")
    assert got[2] == ("net", "", None)
    assert got[3] == ("x.com", "", None)
    assert got[4] == got[5] == got[6] == got[11] == ("", "", None)
    assert got[7][2] == got[9][2] == "example.com/de/"
    assert got[8][2] is None
    assert got[10] == ("b:", "//c/d", None)


def test_features(spark):
    host, path = host_and_path(F.col("url"))
    row = with_features(
        pages(spark).where("page_id = 9").select("url", host.alias("host"), path.alias("path"))
    ).first()
    assert (row["labels"], row["depth"], row["parameters"], row["suffix1"], row["suffix2"]) == (3, 2, 2, "com", "example.com")
    assert 3 < row["entropy"] < 5


def test_trained_verdicts(spark):
    rows = [(i, f"http://{'best-bets' if i % 4 == 0 else 'garden'}{'-x' if i % 4 == 0 else ''}.site{i % 7}.org/{i}") for i in range(400)]
    table = spark.createDataFrame(rows, "page_id bigint, url string")
    model = train(labelled_by_words(table.where("page_id < 300")))
    got = {r["page_id"]: r["verdict"] for r in judge_urls(table, model, []).collect()}
    assert all((got[i] == "block") == (i % 4 == 0) for i, _ in rows)


def test_awkward_tables(spark):
    model = train(labelled_by_words(pages(spark)))
    judged = judge_urls(pages(spark), model, RULES)
    assert judged.columns == ["page_id", "url", "host", "p", "host_", "path", "rule", "verdict", "p_"]
    rows = judged.collect()
    assert len(rows) == len(URLS) + 1
    assert {r["verdict"] for r in rows} <= {"allow", "block"}
    nothing = train(labelled_by_words(pages(spark).limit(0)))
    assert judge_urls(pages(spark).limit(0), nothing, RULES).count() == 0
