"""License scans by patience alignment.

Words that occur once in the text and once in a template are anchors; the longest increasing
subsequence of their places is the backbone of the alignment, and each gap between anchors is
aligned again by itself, where other words are unique. A gap without anchors is matched
from both ends. The densest stretch of the alignment gives the coverage of the template.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import named
from .common import free_name, small_batches

MIN_COVERAGE = 0.8
# A match may be spread over this many times the template's words.
STRETCH = 1.5
_WORD = re.compile(r"\w+(?:\.\w+)*")
# Short notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# Templates of up to this many words are notices: the words that tell siblings apart must be there.
NOTICE_WORDS = 40
# Words that make another license of one that lacks them.
VARIANTS = frozenset(
    "nc nd sa noncommercial noderivatives noderivs sharealike lesser library affero".split()
)
# The texts, headers and further notices of public licenses, in files NAME.KIND.txt.
TEXTS_FOLDER = Path(__file__).parent / "license_texts"


def license_texts() -> list[tuple[str, str]]:
    """(license, text) of the short notices and of all files; a license may have several texts."""
    files = sorted(TEXTS_FOLDER.glob("*.txt"))
    return [*TEMPLATES.items(), *((f.stem.rpartition(".")[0], f.read_text("utf-8")) for f in files)]


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by their first place, whose second places rise (patience sorting)."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        before.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            ends.append(i)
        else:
            tops[pile], ends[pile] = b, i
    chain, at = [], ends[-1] if ends else -1
    while at >= 0:
        chain.append(pairs[at])
        at = before[at]
    return chain[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, rising in both."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and text[a0] == template[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and text[a1 - 1] == template[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        n_text, n_template = Counter(text[a0:a1]), Counter(template[b0:b1])
        place = {template[b]: b for b in range(b0, b1) if n_template[template[b]] == 1}
        anchors = increasing(
            [(a, place[text[a]]) for a in range(a0, a1) if n_text[text[a]] == 1 and text[a] in place]
        )
        if not anchors:
            continue
        found += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(a + 1, c, b + 1, d) for (a, b), (c, d) in zip(edges, edges[1:], strict=False)]
    return sorted(found)


def _is_sibling(name: str, template: list[str], words: list[str], pairs: list[tuple[int, int]]) -> bool:
    """Whether an aligned notice is of another license than ``name``, whatever its coverage.

    Numbers (versions), variants and the parts of the license's name in the template must all be aligned, and
    the text must not hold a further variant between its aligned words.
    """
    if len(template) > NOTICE_WORDS:
        return False
    parts = set(name.lower().split("-"))
    aligned = {b for _, b in pairs}
    if any(
        b not in aligned and (w in parts or w in VARIANTS or any(c.isdigit() for c in w))
        for b, w in enumerate(template)
    ):
        return True
    own = {a for a, _ in pairs}
    return any(a not in own and words[a] in VARIANTS for a in range(pairs[0][0], pairs[-1][0]))


def _stretches(words: list[str], template: list[str], min_coverage: float) -> list[tuple[int, int]]:
    """Parts of the text, in order and apart, where most of the template's words stand close together.

    Only words of the template are looked at. So a long text is cut down to what can hold the template;
    notices that stand close together share a part.
    """
    wanted, width = set(template), int(STRETCH * len(template)) + 1
    places = [i for i, w in enumerate(words) if w in wanted]
    need = min(min_coverage, MIN_COVERAGE) * len(wanted) - 1e-9
    inside: Counter = Counter()
    parts: list[tuple[int, int]] = []
    low = 0
    for i in places:
        inside[words[i]] += 1
        while places[low] <= i - width:
            gone = words[places[low]]
            inside[gone] -= 1
            if not inside[gone]:
                del inside[gone]
            low += 1
        if len(inside) >= need:
            start, end = places[low], i + 1
            if parts and start <= parts[-1][1]:
                parts[-1] = (parts[-1][0], end)
            else:
                parts.append((start, end))
    return parts


def _notices(words: list[str], template: list[str], min_coverage: float) -> list[list[tuple[int, int]]]:
    """The alignment of each notice in a part of a text, in order and apart.

    A notice is looked for from each place of a template word (from each tenth of a long template), in
    a window that holds one notice. After a hit the search goes on behind it, so that each of several adjacent
    notices is aligned by itself. A part without a hit is aligned as a whole.
    """
    wanted, step = set(template), max(1, len(template) // 10)
    width = int(STRETCH * len(template)) + step
    least = min_coverage * len(template) - 1e-9
    found: list[list[tuple[int, int]]] = []
    best: list[tuple[int, int]] = []
    free, tried = 0, -step
    for start in [i for i, w in enumerate(words) if w in wanted]:
        if best and start > best[0][0]:
            found.append(best)
            free, best, tried = best[-1][0] + 1, [], -step
        if len(words) - start < least:
            break
        if start < free or (tried >= 0 and start < tried + step):
            continue
        tried = start
        window = words[start : start + width]
        if len(wanted.intersection(window)) < MIN_COVERAGE * len(wanted) - 1e-9 and min_coverage >= MIN_COVERAGE:
            continue
        pairs = [(a + start, b) for a, b in align(window, template)]
        if pairs and len(pairs) >= least and len(pairs) > len(best):
            best = pairs
    if best:
        found.append(best)
    if not found:
        pairs = align(words, template)
        found = [pairs] if pairs and len(pairs) >= least else []
    return found


def scan_text(
    text: str, templates: list[tuple[str, list[str]]], min_coverage: float
) -> list[tuple[str, float, int, int]]:
    """(license, coverage, start, end) of each notice, code points, end exclusive.

    Where two overlap by more than half of the shorter, the one with more words of its template stays,
    then the one with the higher coverage: a header is no notice besides the text that holds it.
    A short notice of a sibling license (another version, variant or name) is not reported.
    """
    spans = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    words = [text[a:b].lower() for a, b in spans]
    held = set(words)
    hits = []
    for name, template in templates:
        kinds = set(template)
        need = min(min_coverage, MIN_COVERAGE) * len(kinds) - 1e-9
        if len(held) < need or len(held & kinds) < need:
            continue
        for a, b in _stretches(words, template, min_coverage):
            for pairs in _notices(words[a:b], template, min_coverage):
                if _is_sibling(name, template, words[a:b], pairs):
                    continue
                hits.append((-len(pairs), -len(pairs) / len(template), name, a + pairs[0][0], a + pairs[-1][0] + 1))
    kept: list[tuple[str, float, int, int]] = []
    for _, coverage, name, start, end in sorted(hits):
        if all(2 * (min(end, e) - max(start, s)) <= min(end - start, e - s) for _, _, s, e in kept):
            kept.append((name, -coverage, start, end))
    return sorted(
        ((name, coverage, spans[s][0], spans[e - 1][1]) for name, coverage, s, e in kept), key=lambda r: (r[2], r[0])
    )


def find_licenses(
    docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE
) -> DataFrame:
    """The input and ``licenses`` (a free name): array<struct<license, coverage, start, end>> of each whole text.

    ``templates`` (name to text) replaces ``license_texts``. Words are compared in lower case. Null and empty texts have none; rows are independent, so
    repeated rows and null ids make no difference; an empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    texts = license_texts() if templates is None else templates.items()
    cut = [(k, [w.lower() for w in _WORD.findall(v)]) for k, v in texts]

    @F.pandas_udf("array<struct<license string, coverage double, start bigint, end bigint>>")
    def scan(texts: pd.Series) -> pd.Series:
        keys = ("license", "coverage", "start", "end")
        return pd.Series(
            [[dict(zip(keys, r, strict=True)) for r in scan_text(t, cut, min_coverage)] for t in texts], dtype=object
        )

    return docs.withColumn(free_name(docs, "licenses"), scan(F.coalesce(named(text).cast("string"), F.lit(""))))
