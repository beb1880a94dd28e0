"""Tables of awkward rows that every operator has to take."""

from __future__ import annotations

import random

SYLLABLES = "ka lo mi ten ra sou vi der pa ni que sto".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def awkward_rows(seed: int = 1) -> list[tuple]:
    """(doc_id, text): nulls in both columns, empty and blank texts, copies, a repeated row, long texts."""
    rng = random.Random(seed)
    base = [sentence(rng, 40) for _ in range(6)]
    lines = [sentence(rng, 8) for _ in range(5)]
    rows = [(i, "\n".join([text, lines[i % 5], lines[(i + 1) % 5]])) for i, text in enumerate(base)]
    rows += [(20, rows[0][1]), (21, rows[0][1].upper()), (3, rows[3][1])]
    rows += [(30, None), (31, ""), (32, " \t\n "), (33, "one"), (34, "one two"), (35, "\n\n"), (None, "no id at all, really")]
    rows += [(None, None), (40, "x" * 30_000), (41, "\n".join([lines[0]] * 300)), (42, sentence(rng, 6_000))]
    rows += [(43, "é ß Ünïcode \U0001f600 " + base[2]), (44, base[1] + " " + base[4]), (45, base[1] + " more " + base[4])]
    return rows


def awkward_docs(spark, seed: int = 1):
    """The same with columns whose names the operators use themselves."""
    fields = "doc_id bigint, text string, doc string, score string, n_lines int, spans int, row int, version string, h1 int"
    return spark.createDataFrame(
        [(*r, "d", None, 7, 8, None, "v", i) for i, r in enumerate(awkward_rows(seed))], fields
    ).repartition(3)


def empty_docs(spark):
    return awkward_docs(spark).limit(0)
