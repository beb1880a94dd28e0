import itertools
import random

from corpusmill.llm.license_scan import TEMPLATES, align, find_licenses, increasing

from .cases import awkward_docs, awkward_rows, empty_docs


def test_longest_increasing_run():
    rng = random.Random(1)
    for _ in range(200):
        second = rng.sample(range(8), 7)
        best = max(
            n for n in range(8) for c in itertools.combinations(second, n) if list(c) == sorted(c)
        )
        found = increasing(list(enumerate(second)))
        assert len(found) == best and [b for _, b in found] == sorted(b for _, b in found)


def test_alignment_rises_and_fills_gaps():
    text = "a x b b c y d the the e".split()
    template = "a b b c d the the e".split()
    pairs = align(text, template)
    assert [text[a] for a, _ in pairs] == [template[b] for _, b in pairs] == template


def test_notices(spark):
    rows = [(i, f"Some words before. {t} And words after, {i} of them.") for i, t in enumerate(TEMPLATES.values())]
    rows += [(90, " ".join(TEMPLATES.values()) * 1), (91, "under the license of a version")]
    rows += [(92, "x " * 5000 + TEMPLATES["MIT"].upper() + " y" * 5000 + " " + TEMPLATES["MIT"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["licenses"] for r in find_licenses(docs).collect()}
    for i, name in enumerate(TEMPLATES):
        assert name in [f["license"] for f in found[i]]
        hit = next(f for f in found[i] if f["license"] == name)
        assert hit["coverage"] == 1.0 and rows[i][1][hit["start"] : hit["end"]] == TEMPLATES[name].rstrip(".")
    assert found[91] == []
    assert [f["license"] for f in found[92]] == ["MIT", "MIT"]


def test_awkward_rows(spark):
    rows = find_licenses(awkward_docs(spark)).collect()
    assert len(rows) == len(awkward_rows()) and all(r["licenses"] == [] for r in rows)
    assert find_licenses(empty_docs(spark)).count() == 0


def test_adjacent_notices_are_found_one_by_one():
    from corpusmill.llm.license_scan import _WORD, MIN_COVERAGE, scan_text

    cut = [(k, [w.lower() for w in _WORD.findall(v)]) for k, v in TEMPLATES.items()]
    for name, notice in TEMPLATES.items():
        for before, after in (("", ""), ("The ", " the"), ("License / ", " / See the license"), ("under the license ", " licensed under")):
            for n in (1, 2, 3, 5):
                text = before + " / ".join([notice] * n) + after
                hits = [h for h in scan_text(text, cut, MIN_COVERAGE) if h[0] == name]
                assert len(hits) == n, (text, hits)
                assert all(c == 1.0 for _, c, _, _ in hits)
                assert all(a[3] <= b[2] for a, b in zip(hits, hits[1:], strict=False))


def test_reflowed_and_edited_texts_of_licenses(spark):
    from corpusmill.llm.license_scan import license_texts

    rng = random.Random(5)
    rows, names = [], []
    for name, text in license_texts():
        words = text.split()
        edited = list(words)
        for at in rng.sample(range(len(words)), len(words) // 25):
            edited[at] = "otherwise"
        for n, body in enumerate((words, edited)):
            lines = [" * " + " ".join(body[i : i + 9]) for i in range(0, len(body), 9)]
            rows.append((len(rows), "Copyright 2020 Somebody\n" + "\n".join(lines) + "\ndef main():\n    pass\n"))
            names.append((name, n))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {r["doc_id"]: r["licenses"] for r in find_licenses(docs).collect()}
    for i, (name, n) in enumerate(names):
        assert [f["license"] for f in found[i]] == [name], (name, n, [(f["license"], f["coverage"]) for f in found[i]])
        assert found[i][0]["coverage"] == 1.0 or n == 1


def scanned(text, min_coverage=0.8):
    from corpusmill.llm.license_scan import _WORD, license_texts, scan_text

    cut = [(k, [w.lower() for w in _WORD.findall(v)]) for k, v in license_texts()]
    return [h[0] for h in scan_text(text, cut, min_coverage)]


def test_siblings_are_told_apart():
    cc = "This work is licensed under a Creative Commons Attribution"
    for text in (
        "Released under the BSD License.",
        "Released under the Apache License.",
        "This work is licensed under the GNU General Public License, version 2.",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the Apache License, Version 1.1.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-ND 4.0.",
        "Licensed under CC BY-NC-ND 4.0.",
        f"{cc}-NonCommercial 4.0 International License.",
        f"{cc}-NoDerivatives 4.0 International License.",
        f"{cc}-NonCommercial-ShareAlike 4.0 International License.",
        f"{cc} 3.0 International License.",
    ):
        assert scanned(text) == [], text
        assert scanned(f"Some words before. {text} And words after.") == [], text
    for name, text in TEMPLATES.items():
        assert scanned(text) == [name]
    assert scanned(f"{cc}-ShareAlike 4.0 International License.") == ["CC-BY-SA-4.0"]
    assert scanned(f"{cc} 4.0 Intl. License.") == ["CC-BY-4.0"]


def test_lower_coverage_is_honoured():
    from corpusmill.llm.license_scan import TEXTS_FOLDER

    words = (TEXTS_FOLDER / "ISC.text.txt").read_text("utf-8").split()
    part = " ".join(words[: int(0.65 * len(words))])
    assert scanned(part) == []
    assert "ISC" in scanned(part, 0.5)
