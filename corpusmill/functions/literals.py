"""Regular expressions for given words."""

from __future__ import annotations

import sys
import unicodedata
from collections import defaultdict
from functools import lru_cache


@lru_cache(maxsize=1)
def _capitals() -> dict[str, str]:
    """By lower-case character, the others whose lower case it is."""
    found = defaultdict(str)
    for c in map(chr, range(sys.maxunicode + 1)):
        low = c.lower()
        if low != c and len(low) == 1:
            found[low] += c
    return dict(found)


def is_plain_word(word: str) -> bool:
    """Made of word characters, the first no decimal digit, and lower-cased one by one: not so are
    the final sigma and the dot that stays of a capital I with one."""
    kinds = [unicodedata.category(c) for c in word]
    if not word or kinds[0] == "Nd" or set(word) & set("\u03c3\u03c2\u0307"):
        return False
    return all(kind[0] in "LMN" or c == "_" for c, kind in zip(word, kinds))


# So many ways to go on are tried without a look at the next character first.
_FEW_WAYS = 3


def _escaped(c: str) -> str:
    return c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):x}}}"


def one_of(words, any_case: bool = False) -> str:
    """A group that matches any of ``words``, trying common beginnings once; "" for none. With
    ``any_case``, whatever has one of them as its lower case."""
    tree: dict = {}
    for word in words:
        node = tree
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def character(options: str) -> str:
        """A flat set, which Java looks up at once; sets in a set would be tried one after the other."""
        every = "".join(dict.fromkeys("".join(c + (_capitals().get(c, "") if any_case else "") for c in options)))
        return _escaped(every) if len(every) == 1 else "[" + "".join(map(_escaped, every)) + "]"

    def group(node: dict) -> str:
        rest = sorted(c for c in node if c)
        body = "|".join(character(c) + group(node[c]) for c in rest)
        if not body:
            return ""
        if len(rest) > _FEW_WAYS:
            body = f"(?={character(rest)})(?:{body})"
        return f"(?:{body})?" if "" in node else f"(?:{body})"

    return group(tree)
