"""Repair of the structure of conversations.

A repaired conversation is empty or one optional system turn followed by pairs of a user's and an
assistant's turn. The cheapest edits are found by dynamic programming over the turns and four states:
nothing yet, after the system turn, after a user's turn, after an assistant's turn.

Each conversation is a sorted stream. Rows are dealt by conversation once. Sorted backwards, a
first pass carries the cost of the rest for each state over Arrow batches, and gives each row
the first symbol of the best rest from each state: two bits for each of four states, one byte. Rows
and bytes then go through Spark's sort, which spills, and come out forwards; a second pass
follows the bytes. So a task holds a batch and a few numbers, however long a conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import named
from .common import ASCII_BLANKS, small_batches

DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 2, 5, 1, 5
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
# Edits in the order of their letters, which settles ties.
_DELETE, _INSERT, _KEEP, _REROLE = range(4)
_LETTERS = "DIKR"
# What may follow in each state; the last entry but for the system turn is what edits can make.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_MADE = ("user", "user", "assistant", "user")
_MADE_NEXT = (2, 2, 3, 2)
_END = (0, 2 * INSERT_COST, INSERT_COST, 0)
_LEGAL = {"su", "ua", "au"}


def step_back(rest: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int]:
    """The least cost from each state before a row, given those after it, and the first letter of the
    best edits from there, packed."""
    may_stay = fault not in (BLANK, DUPLICATE)
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    options = []
    for state in range(4):
        best = {_DELETE: DELETE_COST + rest[state]}
        if may_stay:
            if initial in _NEXT[state]:
                best[_KEEP] = extra + rest[_NEXT[state][initial]]
            best[_REROLE] = REROLE_COST + extra + rest[_MADE_NEXT[state]]
        options.append(best)
    taken = [min(best.values()) for best in options]
    cost = list(taken)
    # A turn put in before the row leads to another state before the same row.
    cost[2] = min(taken[2], INSERT_COST + taken[3])
    cost[3] = min(taken[3], INSERT_COST + taken[2])
    cost[0] = min(taken[0], INSERT_COST + cost[2])
    cost[1] = min(taken[1], INSERT_COST + cost[2])
    packed = 0
    for state, best in enumerate(options):
        best[_INSERT] = INSERT_COST + cost[_MADE_NEXT[state]]
        packed |= min(edit for edit, c in best.items() if c == cost[state]) << (2 * state)
    return tuple(cost), packed


def _backwards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds ``edits`` and ``at``, the number of rows after this one, to rows that come last first."""
    current, rest, at = None, _END, 0
    for batch in batches:
        edits, places = [], []
        for filled, conv, role, fault in zip(batch["filled"], batch["conv"], batch["role"], batch["fault"], strict=True):
            if (filled, conv) != current:
                current, rest, at = (filled, conv), _END, 0
            rest, packed = step_back(rest, role[:1], fault)
            edits.append(packed)
            places.append(at)
            at += 1
        yield batch.assign(edits=edits, at=places)


class _Walk:
    """Follows the packed edits through one conversation, first row first."""

    def __init__(self):
        self.state = 0

    def before(self, edits: int) -> Iterator[tuple[int, str]]:
        """(edit, role) of the turns put in before a row, then the row's own edit with the role it
        gets, if a new one."""
        while True:
            edit = edits >> (2 * self.state) & 3
            made = _MADE[self.state]
            if edit in (_INSERT, _REROLE):
                self.state = _MADE_NEXT[self.state]
            yield edit, made
            if edit != _INSERT:
                return

    def keep(self, initial: str) -> None:
        self.state = _NEXT[self.state][initial]

    def at_end(self) -> Iterator[str]:
        """The roles of the turns that are still missing."""
        while self.state in (1, 2):
            yield _MADE[self.state]
            self.state = _MADE_NEXT[self.state]


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(batch, filled, conv, row or None, edit, role, text) for each edit, in order. The row is None for
    turns put in at the end."""
    current, walk = None, _Walk()
    for number, batch in enumerate(batches):
        for row in batch.itertuples(index=False):
            if (row.filled, row.conv) != current:
                if current is not None:
                    for role in walk.at_end():
                        yield number, *current, None, _INSERT, role, ""
                current, walk = (row.filled, row.conv), _Walk()
            for edit, made in walk.before(row.edits):
                if edit == _INSERT:
                    yield number, *current, row, edit, made, ""
                elif edit == _KEEP:
                    walk.keep(row.role[:1])
                    yield number, *current, row, edit, row.role, row.text
                else:
                    yield number, *current, row, edit, made, row.text
    if current is not None:
        for role in walk.at_end():
            yield -1, *current, None, _INSERT, role, ""


def _turns_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["filled", "conv", "place", "role", "text", "edit"]
    rows, last, current, place = [], 0, None, 0
    for number, filled, conv, _, edit, role, text in _repaired(batches):
        if (filled, conv) != current:
            current, place = (filled, conv), 0
        if number != last and rows:
            yield pd.DataFrame(rows, columns=names)
            rows = []
        last = number
        if edit != _DELETE:
            rows.append((filled, conv, place, role, text, _LETTERS[edit]))
            place += 1
    if rows:
        yield pd.DataFrame(rows, columns=names)


class _Audit:
    """What is told of one conversation; gathered turn by turn."""

    def __init__(self):
        self.audit = bytearray()
        self.digest = hashlib.sha256()
        self.kept = self.cost = self.illegal = 0
        self.faults = [0] * 4
        self.initial = None
        self.first = self.last = None
        self.distinct = 0

    def seen(self, row) -> None:
        self.faults[row.fault] += 1
        if self.initial is not None and self.initial + row.role[:1] not in _LEGAL:
            self.illegal += 1
        self.initial = row.role[:1]
        if row.timed:
            self.first = row.turn if self.first is None else self.first
            self.distinct += self.last != row.turn
            self.last = row.turn

    def edited(self, row, edit: int, role: str, text: str) -> None:
        self.audit += _LETTERS[edit].encode()
        self.cost += (DELETE_COST, INSERT_COST, 0, REROLE_COST)[edit]
        if edit == _DELETE:
            return
        if edit != _INSERT and row.fault == TRUNCATED:
            self.cost += TRUNCATED_COST
        if self.kept:
            self.digest.update(b"\n")
        self.kept += 1
        self.digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return (
            gaps, *(self.faults[f] for f in (BLANK, DUPLICATE, TRUNCATED)), self.illegal, self.cost,
            self.audit.decode(), self.digest.hexdigest(),
        )


_AUDIT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_AUDIT_NAMES = [field.split()[0] for field in _AUDIT.split(", ")]


def _audits_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["filled", "conv", *_AUDIT_NAMES]
    done, current, audit = [], None, _Audit()
    for _, filled, conv, row, edit, role, text in _repaired(batches):
        if (filled, conv) != current:
            if current is not None:
                done.append((*current, *audit.row()))
            current, audit = (filled, conv), _Audit()
            if len(done) >= 1000:
                yield pd.DataFrame(done, columns=names)
                done = []
        if row is not None and edit != _INSERT:
            audit.seen(row)
        audit.edited(row, edit, role, text)
    if current is not None:
        yield pd.DataFrame([*done, (*current, *audit.row())], columns=names)


def faults(rows: DataFrame) -> Column:
    """The first fault of a row (conv, turn, role, text, seen)."""
    stripped = F.rtrim("text", F.lit(ASCII_BLANKS))
    return (
        F.when(stripped == "", BLANK)
        .when(F.col("seen") > 1, DUPLICATE)
        .when(~F.substring(stripped, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND)
    )


def _streams(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Each task has whole conversations, sorted, with the edits of every row."""
    small_batches(rows.sparkSession)

    def plain(name: str) -> Column:
        return F.coalesce(named(name).cast("string"), F.lit(" "))

    dealt = rows.select(
        named(key).isNotNull().alias("filled"),
        F.coalesce(named(key).cast("string"), F.lit("")).alias("conv"),
        named(turn).cast("bigint").alias("turn"),
        plain(role).alias("role"),
        plain(text).alias("text"),
    ).repartition("filled", "conv")
    again = Window.partitionBy("filled", "conv", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    marked = dealt.withColumn("seen", F.row_number().over(again))
    fields = "filled boolean, conv string, timed boolean, turn bigint, role string, text string, fault int"
    backwards = (
        marked.withColumn("fault", faults(marked))
        .sortWithinPartitions(
            "filled", "conv", F.col("turn").desc_nulls_last(), *[F.col(c).desc() for c in ("role", "text", "seen")]
        )
        .select(
            "filled", "conv", F.col("turn").isNotNull().alias("timed"), F.coalesce("turn", F.lit(0)).alias("turn"),
            "role", "text", "fault",
        )
        .mapInPandas(_backwards, f"{fields}, edits int, at bigint")
    )
    return backwards.sortWithinPartitions("filled", "conv", F.col("at").desc())


def _with_key(found: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    kind = rows.schema[key].dataType
    names = [c for c in found.columns if c not in ("filled", "conv")]
    return found.select(F.when(F.col("filled"), F.col("conv").cast(kind)).alias(key), *names)


def repaired_turns(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(key, place, role, text, edit): the repaired conversations, a row per turn.

    ``edit`` is K for a turn that stays, R for one with a new role, I for one put in, with an empty
    text. ``place`` counts from 0. A conversation that loses all turns has no row. See ``audits``.
    """
    found = _streams(rows, key, turn, role, text).mapInPandas(
        _turns_of, "filled boolean, conv string, place bigint, role string, text string, edit string"
    )
    return _with_key(found, rows, key)


def audits(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row per conversation.

    Turns are ordered by ``turn``, null first, then by role and text; a turn that repeats an earlier
    one's role and text is a duplicate. Blank turns and duplicates have to go (2), any other may go
    (2), stay (0) or get the role user or assistant (1); a turn with an empty text may be put in
    (5); a truncated turn that is not deleted costs 5 more. ``audit`` has the initials of the cheapest
    edits (delete, insert, keep, rerole), of several the first in ASCII order.

    Null roles and texts are one space; an empty text is blank. Rows with a null key are one
    conversation. ``gaps`` counts the missing numbers between the known turns. Repeated rows are
    duplicates. A very long text or conversation is streamed. Other columns are not read, so they
    cannot clash; an empty table gives an empty table. One conversation is one task's work,
    in bounded memory but for its audit, a byte per edit.
    """
    found = _streams(rows, key, turn, role, text).mapInPandas(_audits_of, f"filled boolean, conv string, {_AUDIT}")
    return _with_key(found, rows, key)


def damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, turn, role, text): the rows with faults by crc32(``key:turn``) modulo 20: 0 drops the row, 1
    empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets the role user. A null is one space."""

    def plain(name: str) -> Column:
        return F.coalesce(named(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain(key), F.lit(":"), plain(turn))) % 20
    hurt = rows.select(
        named(key).alias("key"), named(turn).alias("turn"), plain(role).alias("role"), plain(text).alias("text"), kind.alias("kind")
    ).where(F.col("kind") != 0)
    return hurt.select(
        F.col("key").alias(key),
        F.col("turn").alias(turn),
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias(role),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias(text),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def audits_of_all(rows: DataFrame, present: DataFrame, key: str = "conv_id") -> DataFrame:
    """``audits`` of ``present`` with a row for every key of ``rows``: zeros, an empty audit and the hash of the
    empty string for those that have none there."""
    found = audits(present, key).withColumnRenamed(key, "found_key").withColumn("found", F.lit(True))
    everyone = rows.select(named(key).alias("key")).distinct()
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return everyone.join(found, F.col("key").eqNullSafe(F.col("found_key")), "left").select(
        F.col("key").alias(key),
        *[F.coalesce(F.col(c), F.lit(nothing.get(c, 0))).alias(c) for c in _AUDIT_NAMES],
    )
