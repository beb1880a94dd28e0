import random
import re

import pytest

from corpusmill.llm.secret_scan import BASE_RULES, RULES, Rule, Scanner, find_secrets

from .cases import awkward_docs, awkward_rows, empty_docs

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
PIECES = [
    "password", "PassWord", "passwd", "secret", "token", "api_key", "apikey", "API_KEY", ":", "=", '"', "'", " ", "  ",
    "\n", "abc123", "deadbeef" * 4, "AKIA", "ABCDEF0123456789", "é", "ſ", "\u212a", "x", "-", "/", "0123456789abcdef", "tok",
]


def brute(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    for rank, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        found += [(m.start(), rank, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [(BASE_RULES[k].kind, a, b) for a, k, b in sorted(found)]


@pytest.fixture(scope="module")
def scanner():
    return Scanner(BASE_RULES)


def test_against_regular_expressions(scanner):
    rng = random.Random(3)
    for _ in range(5000):
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 14)))
        assert scanner.scan(text) == brute(text), text


def test_counts_and_alternatives():
    rules = (Rule("a", "x(ab|c){2,3}y"), Rule("b", "q{2}"), Rule("c", "z[0-9]{1,}", 3))
    text = "xabcy xcy xccabyx qqq z1 z12 é z123"
    assert Scanner(rules).scan(text) == [
        ("a", 0, 5), ("a", 10, 16), ("b", 18, 20), ("c", 25, 28), ("c", 31, 35),
    ]


def test_rules_that_may_stop_half_way_are_refused():
    with pytest.raises(ValueError):
        Scanner((Rule("x", "ab(cd)?"),))


def test_added_rules():
    scan = Scanner(RULES).scan
    assert ("github", 2, 42) in scan("é ghp_" + "a1B2" * 9 + "!")
    assert ("pem", 1, 32) in scan("\n-----BEGIN RSA PRIVATE KEY-----\nMII")


def test_awkward_rows(spark):
    extra = [(50, "é password: abcdefgh1, AKIA" + "B" * 20)]
    docs = awkward_docs(spark).select("doc_id", "text", "spans").union(
        spark.createDataFrame([(*extra[0], 1)], "a bigint, b string, c int")
    )
    found = find_secrets(docs, rules=BASE_RULES)
    assert found.columns == ["doc_id", "text", "spans", "spans_"]
    got = sorted(repr((r["doc_id"], [tuple(s) for s in r["spans_"]])) for r in found.collect())
    assert got == sorted(repr((i, brute(t or ""))) for i, t in awkward_rows() + extra)
    assert find_secrets(empty_docs(spark)).count() == 0
