import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from corpusmill.llm import conversation

FIELDS = "conv_id bigint, turn bigint, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"
MADE = {"u": "user", "a": "assistant"}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(BLANKS)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_repair(rows, most_inserts):
    """(cost, audit, repaired) of all edits with a few turns put in, by enumeration."""
    wrong = faults(rows)
    found = []

    def go(i, inserts, cost, audit, roles):
        initials = "".join(r[0][:1] or "?" for r in roles)
        if not re.fullmatch("(s?(ua)*u?)", initials):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            found.append((cost, audit, "\n".join(f"{r}:{t}" for r, t in roles)))
        if inserts:
            for initial in "ua":
                go(i, inserts - 1, cost + 5, audit + "I", [*roles, (MADE[initial], "")])
        if i < len(rows):
            _, role, text = rows[i]
            go(i + 1, inserts, cost + 2, audit + "D", roles)
            if wrong[i] in ("", "truncated"):
                more = 5 if wrong[i] else 0
                go(i + 1, inserts, cost + more, audit + "K", [*roles, (role, text)])
                for initial in "ua":
                    go(i + 1, inserts, cost + 1 + more, audit + "R", [*roles, (MADE[initial], text)])

    go(0, most_inserts, 0, "", [])
    return min(found)


def expected(rows, most_inserts=3):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, turns in talks.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        wrong = faults(turns)
        known = [t for t, _, _ in turns if t is not None]
        initials = [r[:1] for _, r, _ in turns]
        cost, audit, repaired = every_repair(turns, most_inserts)
        out.append((
            conv, max(known) - min(known) + 1 - len(set(known)) if known else 0,
            wrong.count("blank"), wrong.count("duplicate"), wrong.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost, audit, hashlib.sha256(repaired.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["conv_id", *"gaps blank duplicate truncated illegal cost audit repaired_sha256".split()]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_talks(rng, n, longest):
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"])
            text = rng.choice(["yes.", "no!", "why? ", "cut off", "", None, " \t\n", f"text {turn}.", "é \U0001f600?"])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), role, text))
    return rows


def awkward_talks():
    rows = random_talks(random.Random(4), 150, 5)
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (900, None, None, None), (900, None, None, None)]
    rows += [(901, 0, "user", "long " * 50_000 + "."), (901, 1, "assistant", "x" * 200_000 + "!")]
    rows += [(902, 5, "system", "s."), (902, 5, "system", "s."), (902, 9, "user", "u.")]
    return rows


def test_awkward_rows(spark):
    rows = awkward_talks()
    wide = spark.createDataFrame(
        [(*r, "f", 3, 0) for r in rows], FIELDS + ", filled string, fault int, conv int"
    ).repartition(5)
    assert got(conversation.audits(wide)) == expected(rows)
    assert got(conversation.audits(wide.limit(0))) == []


def test_batches_and_keys(spark, monkeypatch):
    """Conversations that go over many Arrow batches, and text keys."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = random_talks(random.Random(9), 60, 6)
        df = spark.createDataFrame([(f"c {c}", *r) for c, *r in rows], FIELDS.replace("conv_id bigint", "conv_id string"))
        found = got(conversation.audits(df))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert found == sorted([(f"c {r[0]}", *r[1:]) for r in expected(rows)], key=repr)


def test_repaired_turns_match_the_audit(spark):
    rows = awkward_talks()
    df = spark.createDataFrame(rows, FIELDS).repartition(4)
    talks = defaultdict(list)
    for r in conversation.repaired_turns(df).orderBy("conv_id", "place").collect():
        talks[r["conv_id"]].append(r)
    for conv, *_, audit, sha in got(conversation.audits(df)):
        turns = talks.get(conv, [])
        assert [t["place"] for t in turns] == list(range(len(turns)))
        assert "".join(t["edit"] for t in turns) == audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in turns).encode()).hexdigest() == sha


def test_a_giant_conversation(spark):
    """Thousands of turns in one stream; alternating ones stay, each third one is truncated and goes with the next."""
    rows = [(1, i, ("user", "assistant")[i % 2], f"text {i}" + ("" if i % 300 == 7 else ".")) for i in range(6000)]
    df = spark.createDataFrame(rows + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")], FIELDS).repartition(3)
    found = {r["conv_id"]: r for r in conversation.audits(df).collect()}
    assert found[1]["truncated"] == 20 and found[1]["illegal"] == 0 and found[1]["gaps"] == 0
    # Deleting a truncated assistant turn and the user turn beside it costs 4, keeping it 5.
    assert found[1]["cost"] == 20 * 4 and found[1]["audit"].count("D") == 40
    assert found[2]["audit"] == "KK"


@pytest.mark.parametrize("rows, audit, cost", [
    ([(0, "user", "a."), (1, "assistant", "b.")], "KK", 0),
    ([(0, "system", "s.")], "D", 2),
    ([(0, "user", "a."), (1, "user", "b.")], "KR", 1),
    ([(0, "user", "a.")], "D", 2),
    ([(0, "assistant", "a."), (1, "user", "b.")], "RR", 2),
    ([(0, "user", "a."), (1, "assistant", "b."), (2, "user", "c."), (3, "assistant", "")], "KKDD", 4),
])
def test_costs(spark, rows, audit, cost):
    df = spark.createDataFrame([(1, *r) for r in rows], FIELDS)
    (found,) = conversation.audits(df).collect()
    assert (found["audit"], found["cost"]) == (audit, cost)


def test_damage_and_all_keys(spark):
    rows = random_talks(random.Random(11), 300, 4) + [(None, 3, "user", None), (None, None, None, "x.!?")]
    df = spark.createDataFrame(rows, FIELDS).repartition(4)
    hurt = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            hurt += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    present = conversation.damaged(df)
    assert sorted(map(repr, map(tuple, present.collect()))) == sorted(map(repr, hurt))
    gone = {r[0] for r in rows} - {r[0] for r in hurt}
    assert gone
    empty = [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c in gone]
    assert got(conversation.audits_of_all(df, present)) == sorted(expected(hurt) + empty, key=repr)


def test_one_shuffle_by_conversation(spark):
    df = spark.createDataFrame(awkward_talks(), FIELDS)
    plan = conversation.audits(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
