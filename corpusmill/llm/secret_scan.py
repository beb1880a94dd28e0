"""Secret scans by one deterministic automaton for all rules.

Rule regexes become nondeterministic automata; subset construction joins them into one
automaton over byte classes, which is then minimised and laid out as one transition array. A text
is scanned in a single pass over its bytes, whatever the number of rules. The automaton tells
where a match of a rule ends; its start follows from the reversed rule, run backwards over the
match alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import named
from .common import free_name, small_batches


@dataclass(frozen=True)
class Rule:
    """Leftmost-longest, non-overlapping matches of ``pattern``, of ``least`` characters or more.

    ``pattern`` knows literals, classes, groups, ``|``, ``?``, ``*``, ``+`` and counts. With
    ``head``, the match less its leading ``head`` must have ``least_tail`` characters. A match
    that fails these lengths is dropped, and what it covered is not searched again.
    """

    kind: str
    pattern: str
    least: int = 1
    ignore_case: bool = False
    head: str = ""
    least_tail: int = 0


# The three base rules, then formats of public services.
_ASSIGN_HEAD = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    Rule("assign", _ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]+", 1, True, _ASSIGN_HEAD, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
RULES = (
    *BASE_RULES,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
)


class _Nfa:
    """Thompson's construction: states with byte-set edges and empty edges."""

    def __init__(self, pattern: str, ignore_case: bool, backwards: bool = False):
        self.text, self.at = pattern, 0
        self.ignore_case, self.backwards = ignore_case, backwards
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []
        self.first, self.last = self._either()
        if self.at != len(pattern):
            raise ValueError(f"unbalanced pattern: {pattern}")

    def _state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _either(self) -> tuple[int, int]:
        parts = [self._row()]
        while self._peek() == "|":
            self.at += 1
            parts.append(self._row())
        if len(parts) == 1:
            return parts[0]
        first, last = self._state(), self._state()
        for a, b in parts:
            self.empty[first].append(a)
            self.empty[b].append(last)
        return first, last

    def _row(self) -> tuple[int, int]:
        parts = []
        while self._peek() and self._peek() not in "|)":
            parts.append(self._repeated())
        if self.backwards:
            parts.reverse()
        if not parts:
            state = self._state()
            return state, state
        for (_, b), (a, _) in zip(parts, parts[1:], strict=False):
            self.empty[b].append(a)
        return parts[0][0], parts[-1][1]

    def _repeated(self) -> tuple[int, int]:
        begin = self.at
        part = self._one()
        end = self.at
        sign = self._peek()
        counts = re.compile(r"\{(\d+)(,?)(\d*)\}").match(self.text, self.at)
        if sign and sign in "?*+":
            self.at += 1
            return self._loop(part, sign)
        if not counts:
            return part
        after = counts.end()
        low, high = int(counts[1]), int(counts[3] or counts[1])
        copies = [part]
        for i in range(1, max(high, low + (counts[2] == "," and not counts[3]))):
            self.at = begin
            copies.append(self._one())
        assert self.at == end
        self.at = after
        for i, copy in enumerate(copies):
            if i >= low:
                copies[i] = self._loop(copy, "*" if counts[2] and not counts[3] else "?")
        for (_, b), (a, _) in zip(copies, copies[1:], strict=False):
            self.empty[b].append(a)
        return copies[0][0], copies[-1][1]

    def _loop(self, part: tuple[int, int], sign: str) -> tuple[int, int]:
        first, last = self._state(), self._state()
        self.empty[first].append(part[0])
        self.empty[part[1]].append(last)
        if sign in "?*":
            self.empty[first].append(last)
        if sign in "*+":
            self.empty[part[1]].append(part[0])
        return first, last

    def _one(self) -> tuple[int, int]:
        if self._peek() == "(":
            self.at += 1
            inner = self._either()
            if self._peek() != ")":
                raise ValueError(f"unbalanced pattern: {self.text}")
            self.at += 1
            return inner
        taken = self._class() if self._peek() == "[" else {self._char()}
        if self.ignore_case:
            taken |= {ord(c) for b in taken for c in (chr(b).lower(), chr(b).upper()) if chr(b).isalpha()}
        a, b = self._state(), self._state()
        self.edges[a].append((frozenset(taken), b))
        return a, b

    def _char(self) -> int:
        c = self._peek()
        self.at += 1
        if c == "\\":
            c = self._peek()
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
        if ord(c) > 127:
            raise ValueError("rules are ASCII")
        return ord(c)

    def _class(self) -> set[int]:
        self.at += 1
        taken: set[int] = set()
        while self._peek() != "]":
            low = self._char()
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                taken |= set(range(low, self._char() + 1))
            else:
                taken.add(low)
        self.at += 1
        return taken

    def closed(self, states: Iterable[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)

    def moved(self, states: Iterable[int], byte: int) -> frozenset[int]:
        return self.closed([b for s in states for taken, b in self.edges[s] if byte in taken])


def _threads(nfa: _Nfa, state: tuple, byte: int) -> tuple[tuple, bool]:
    """The next state of a rule's search, and whether a match ended before ``byte``.

    A state is the subsets of the searches that are alive, by their starts; of two that stand
    at one place, the earlier stays. Once one accepts, no later one counts.
    """
    accepting = bool(state) and nfa.last in state[-1]
    searches = state if accepting else (*state, nfa.closed([nfa.first]))
    moved, taken = [], frozenset()
    for i, search in enumerate(searches):
        whole = nfa.moved(search, byte)
        if accepting and i == len(searches) - 1:
            if not whole and i == 0:
                return _threads(nfa, (), byte)[0], True
            if nfa.last not in whole:
                raise ValueError(f"a match of {nfa.text} may go on without accepting")
        if new := whole - taken:
            moved.append(new)
            taken |= new
        if nfa.last in new:
            break
    return tuple(moved), False


class Scanner:
    """The minimal automaton of several rules, and their reversed forms."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        nfas = [_Nfa(r.pattern, r.ignore_case) for r in rules]
        self._byte_classes(nfas)
        self._minimise(*self._subsets(nfas))
        self.backwards = [_Nfa(r.pattern, r.ignore_case, True) for r in rules]
        self.heads = [re.compile(r.head, re.IGNORECASE * r.ignore_case) for r in rules]
        self.known: dict[tuple, frozenset[int]] = {}

    def _byte_classes(self, nfas: list[_Nfa]) -> None:
        """Bytes that no rule tells apart are one class; the last class stands for the end."""
        sets = [taken for nfa in nfas for edges in nfa.edges for taken, _ in edges]
        kinds: dict[tuple, int] = {}
        self.table = bytes(kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256))
        self.end = kinds.setdefault(tuple(False for _ in sets), len(kinds))
        self.examples = [self.table.find(k) for k in range(len(kinds))]
        if self.examples[self.end] < 0:
            self.examples[self.end] = 256

    def _subsets(self, nfas: list[_Nfa]) -> tuple[list[list[int]], list[list[tuple[int, ...]]]]:
        """Next state, and rules whose match ends, for each state and byte class."""
        single: dict[tuple, tuple[tuple, bool]] = {}

        def step(i: int, state: tuple, byte: int) -> tuple[tuple, bool]:
            if (i, state, byte) not in single:
                single[i, state, byte] = _threads(nfas[i], state, byte)
            return single[i, state, byte]

        start = tuple(() for _ in nfas)
        number, todo = {start: 0}, [start]
        follow, ended = [], []
        while todo:
            steps = [[step(i, s, b) for i, s in enumerate(todo[0])] for b in self.examples]
            todo.pop(0)
            row = []
            for parts in steps:
                joint = tuple(p[0] for p in parts)
                if joint not in number:
                    number[joint] = len(number)
                    todo.append(joint)
                row.append(number[joint])
            follow.append(row)
            ended.append([tuple(i for i, p in enumerate(parts) if p[1]) for parts in steps])
        return follow, ended

    def _minimise(self, follow: list[list[int]], ended: list[list[tuple[int, ...]]]) -> None:
        """Moore's refinement: states stay together while all their steps do."""
        group, n = [0] * len(follow), 0
        while True:
            kinds: dict[tuple, int] = {}
            group = [
                kinds.setdefault((group[s], *ended[s], *[group[t] for t in row]), len(kinds))
                for s, row in enumerate(follow)
            ]
            if len(kinds) == n:
                break
            n = len(kinds)
        width = len(self.examples)
        self.steps, self.ends = [0] * (n * width), []
        for s, row in enumerate(follow):
            for k, t in enumerate(row):
                to = group[t] * width
                if ended[s][k]:
                    self.ends.append((to, ended[s][k]))
                    to = -len(self.ends)
                self.steps[group[s] * width + k] = to
        self.start = group[0] * width
        self.n_states = n

    def _begin(self, rule: int, data: bytes, low: int, end: int) -> int:
        """Where the longest match of the rule that ends at ``end`` begins, from ``low`` on."""
        nfa, known = self.backwards[rule], self.known
        state, best = nfa.closed([nfa.first]), end
        for at in range(end - 1, low - 1, -1):
            key = (rule, state, data[at])
            if key not in known:
                known[key] = nfa.moved(state, data[at])
            state = known[key]
            if not state:
                break
            if nfa.last in state:
                best = at
        return best

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start and then by the order of the rules."""
        data = text.encode("utf-8", "surrogatepass")
        steps, state, hits = self.steps, self.start, []
        for at, k in enumerate(data.translate(self.table) + bytes([self.end])):
            state = steps[state + k]
            if state < 0:
                state, rules = self.ends[-1 - state]
                hits.extend((rule, at) for rule in rules)
        found, low = [], [0] * len(self.rules)
        for rule, end in hits:
            begin = self._begin(rule, data, low[rule], end)
            low[rule] = end
            if self._long_enough(self.rules[rule], self.heads[rule], data[begin:end]):
                found.append((begin, rule, end))
        found.sort()
        place = {b: b for f in found for b in (f[0], f[2])}
        if len(data) != len(text):
            last, chars = 0, 0
            for b in sorted(place):
                chars += len(data[last:b].decode("utf-8", "surrogatepass"))
                last = b
                place[b] = chars
        return [(self.rules[r].kind, place[a], place[b]) for a, r, b in found]

    @staticmethod
    def _long_enough(rule: Rule, head: re.Pattern, match: bytes) -> bool:
        if len(match) < rule.least:
            return False
        if not rule.least_tail:
            return True
        return len(match) - head.match(match.decode("ascii")).end() >= rule.least_tail


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def find_secrets(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The input and ``spans`` (a free name): array<struct<kind, start, end>> of each whole text.

    Offsets are code points, ends exclusive; spans are ordered by start, then as the rules
    are listed, and those of different rules may overlap. A null or empty text has none.
    Rows are independent: repeated rows and null ids make no difference.
    """

    small_batches(docs.sparkSession)
    handed = docs.sparkSession.sparkContext.broadcast(scanner(rules))

    @F.pandas_udf("array<struct<kind string, start bigint, end bigint>>")
    def spans(texts: pd.Series) -> pd.Series:
        scan = handed.value.scan
        return pd.Series(
            [[{"kind": k, "start": a, "end": b} for k, a, b in scan(t)] for t in texts], dtype=object
        )

    return docs.withColumn(free_name(docs, "spans"), spans(F.coalesce(named(text).cast("string"), F.lit(""))))
