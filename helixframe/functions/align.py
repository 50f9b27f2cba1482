"""Prefix alignment of a short pattern against the start of a read window."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np


@dataclass(frozen=True)
class Hit:
    """What an element took from a read."""

    barcode: str
    consumed: int
    insertions: int = 0
    deletions: int = 0
    substitutions: int = 0

    @property
    def edits(self) -> int:
        return self.insertions + self.deletions + self.substitutions


def _table(pattern: str, target: str) -> list[list[int]]:
    rows = [list(range(len(target) + 1))]
    for i, p in enumerate(pattern, 1):
        above, row = rows[-1], [i]
        for j, t in enumerate(target, 1):
            row.append(min(above[j - 1] + (p != t), above[j] + 1, row[j - 1] + 1))
        rows.append(row)
    return rows


@lru_cache(maxsize=200_000)
def prefix_align(pattern: str, target: str, most: int) -> tuple[int, int, int, int] | None:
    """(consumed, insertions, deletions, substitutions), or None beyond ``most`` edits.

    The pattern is aligned with whatever prefix of the target is nearest; of equally near ones the
    shortest. An insertion takes a base of the target alone, a deletion one of the pattern alone.
    Of equally cheap scripts the one is taken that, from the end, prefers a diagonal step, then a
    deletion, then an insertion. Edits behind the last match count as substitutions, each of which
    takes one base of the target.
    """
    rows = _table(pattern, target)
    last = rows[-1]
    best = min(last)
    if best > most:
        return None
    j, i, script = last.index(best), len(pattern), []
    while i or j:
        if i and j and rows[i][j] == rows[i - 1][j - 1] + (pattern[i - 1] != target[j - 1]):
            script.append("M" if pattern[i - 1] == target[j - 1] else "S")
            i, j = i - 1, j - 1
        elif i and rows[i][j] == rows[i - 1][j] + 1:
            script.append("D")
            i -= 1
        else:
            script.append("I")
            j -= 1
    tail = 0
    while tail < len(script) and script[tail] != "M":
        tail += 1
    body = script[tail:]
    subs = body.count("S") + tail
    return len(body) - body.count("D") + tail, body.count("I"), body.count("D"), subs


def prefix_distances(patterns: np.ndarray, lengths: np.ndarray, target: str) -> np.ndarray:
    """The least prefix distance of each pattern, all at once.

    ``patterns`` holds a row of character codes for each pattern, filled up at its end.
    """
    t = np.frombuffer(target.encode(), np.uint8)
    row = np.broadcast_to(np.arange(len(t) + 1), (len(patterns), len(t) + 1)).copy()
    best = np.full(len(patterns), np.iinfo(np.int64).max)
    for i in range(patterns.shape[1]):
        after = np.empty_like(row)
        after[:, 0] = i + 1
        cost = patterns[:, i : i + 1] != t[None, :]
        step = np.minimum(row[:, :-1] + cost, row[:, 1:] + 1)
        for j in range(len(t)):
            after[:, j + 1] = np.minimum(step[:, j], after[:, j] + 1)
        row = after
        done = lengths == i + 1
        best[done] = row[done].min(axis=1)
    return best


def within_distance(a: str, b: str, most: int, hamming: bool) -> bool:
    """Whether two sequences are within ``most`` edits, or substitutions of equally long ones."""
    if hamming:
        return len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) <= most
    return abs(len(a) - len(b)) <= most and _table(a, b)[-1][-1] <= most
