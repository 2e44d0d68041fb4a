"""Byte-pair merging and the compatibility of adjacent tokens.

A token sequence is the encoding of its text exactly if its first token and
every two adjacent tokens come back unchanged when their characters are
merged again; both tokenisers here rest on that local check.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import ahocorasick


NEVER = float("inf")


class Pairs:
    """rank(a, b): priority of merging two symbols (lowest first, leftmost
    on ties), NEVER where they don't merge."""

    LIMIT = 400_000  # remembered answers; then it starts anew

    def __init__(self, rank: Callable[[str, str], float]):
        self.rank = rank
        self.known: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        parts, rank = list(text), self.rank
        ranks = list(map(rank, parts, parts[1:]))
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1], parts[at])
            if at < len(ranks):
                ranks[at] = rank(parts[at], parts[at + 1])
        return parts

    def fit(self, left: str, right: str) -> bool:
        """Does ``right`` follow ``left`` in an encoding ('' : at the start)?"""
        got = self.known.get((left, right))
        if got is None:
            if len(self.known) >= self.LIMIT:
                self.known.clear()
            got = self.merge(left + right) == ([left, right] if left else [right])
            self.known[left, right] = got
        return got


def automaton(tokens: Iterable[str], value: Callable = len) -> ahocorasick.Automaton:
    """Finds every token in a text; gives the place of its last character
    and ``value`` of it."""
    a = ahocorasick.Automaton()
    for t in tokens:
        a.add_word(t, value(t))
    a.make_automaton()
    return a


class Memo(dict):
    """Remembers a function's values of short strings; starts anew when full."""

    def __init__(self, function: Callable, limit: int, longest: int = 64):
        super().__init__()
        self.function, self.limit, self.longest = function, limit, longest

    def __missing__(self, key: str):
        got = self.function(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[key] = got
        return got
