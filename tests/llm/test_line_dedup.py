from collections import defaultdict

from corpusmill.llm.line_dedup import drop_repeated_lines

from .cases import awkward_docs, awkward_rows, empty_docs

BLANKS = " \t\n\x0b\x0c\r"
FOLD = {c: c + 32 for c in range(65, 91)}


def expected(rows, min_chars, min_docs):
    order = lambda i: (i is not None, i or 0)
    owners = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            owners[line.strip(BLANKS).translate(FOLD)].add(doc)
    out = []
    for doc, text in rows:
        kept, lines = [], (text or "").split("\n")
        for line in lines:
            key = line.strip(BLANKS).translate(FOLD)
            held = owners[key]
            if len(key) < min_chars or len(held) < min_docs or min(held, key=order) == doc:
                kept.append(line)
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_awkward_rows(spark):
    for min_docs in (2, 3):
        found = drop_repeated_lines(awkward_docs(spark), min_docs=min_docs)
        assert found.columns[-2:] == ["n_lines_", "n_dropped"]
        got = sorted(((r["doc_id"], r["text"], r["n_lines_"], r["n_dropped"]) for r in found.collect()), key=repr)
        assert got == expected(awkward_rows(), 10, min_docs)


def test_other_columns_stay(spark):
    docs = awkward_docs(spark)
    kept = drop_repeated_lines(docs).select(docs.columns[2:])
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, docs.select(docs.columns[2:]).collect()))


def test_empty_table(spark):
    assert drop_repeated_lines(empty_docs(spark)).count() == 0
