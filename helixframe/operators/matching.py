"""Matching of one read with one pattern, element by element."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from itertools import product

import numpy as np

from ..functions.align import Hit, prefix_align, prefix_distances
from ..plans.pattern import Element, Kind, Pattern, reversed_elements

#: Letters that substitutions and insertions of the neighbourhoods try.
LETTERS = "ATGCN"
AMBIGUOUS = None


@dataclass(frozen=True)
class MatchOptions:
    hamming: bool = False
    precalculate_indels: bool = True
    #: Lists of mixed lengths longer than this are not aligned, nor are more barcodes of equal length
    #: than this that are all within the allowed edits; such a read fails there.
    max_candidates: int = 2000


def substitution_table(barcodes: Sequence[str]) -> dict[str, str | None]:
    """Every word one substitution from a barcode; None where two barcodes (or one twice) claim it."""
    out: dict[str, str | None] = {}
    for b in barcodes:
        for i, letter in product(range(len(b)), LETTERS):
            if letter != b[i]:
                key = b[:i] + letter + b[i + 1 :]
                out[key] = AMBIGUOUS if key in out else b
    return out


def indel_tables(barcodes: Sequence[str]) -> tuple[dict[str, str | None], dict[str, str | None]]:
    """Words one insertion, and one deletion, from a barcode; None where different barcodes claim it."""
    inserted: dict[str, str | None] = {}
    deleted: dict[str, str | None] = {}

    def claim(table: dict[str, str | None], key: str, b: str) -> None:
        table[key] = b if table.get(key, b) == b else AMBIGUOUS

    for b in barcodes:
        for i, letter in product(range(len(b) + 1), LETTERS):
            claim(inserted, b[:i] + letter + b[i:], b)
        for i in range(len(b)):
            claim(deleted, b[:i] + b[i + 1 :], b)
    return inserted, deleted


class Matcher:
    """One element, ready to be tried at places of reads."""

    def __init__(self, element: Element, emitted: Sequence[str] | None, options: MatchOptions) -> None:
        self.element, self.options, self.equal_length = element, options, element.equal_length
        #: What is written for a barcode: itself, or its complement on the opposite strand.
        self.emit = dict(zip(element.barcodes, emitted, strict=True)) if emitted is not None else {}
        self.align_all = lru_cache(maxsize=100_000)(self._align_all)

    @cached_property
    def exact(self) -> frozenset[str]:
        return frozenset(self.element.barcodes)

    @cached_property
    def substitutions(self) -> dict[str, str | None]:
        return substitution_table(self.element.barcodes)

    @cached_property
    def indels(self) -> tuple[dict[str, str | None], dict[str, str | None]]:
        return indel_tables(self.element.barcodes)

    @cached_property
    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        width = max(map(len, self.element.barcodes))
        rows = [list(b.ljust(width, "\0").encode()) for b in self.element.barcodes]
        return np.array(rows, np.uint8), np.array([len(b) for b in self.element.barcodes])

    @cached_property
    def pieces(self) -> list[tuple[int, int, dict[str, list[int]]]]:
        """Start and end of each of ``max_edits`` + 1 pieces of equally long barcodes, and the barcodes by its letters."""
        e, n = self.element, self.element.max_edits + 1
        out = []
        for p in range(n):
            start, end = e.length * p // n, e.length * (p + 1) // n
            by_letters: dict[str, list[int]] = {}
            for i, b in enumerate(e.barcodes):
                by_letters.setdefault(b[start:end], []).append(i)
            out.append((start, end, by_letters))
        return out

    def at(self, read: str, offset: int) -> Hit | None:
        """What the element takes from ``read`` at ``offset``, or None."""
        e = self.element
        if e.kind is Kind.RANDOM:
            return Hit(read[offset : offset + e.length], min(e.length, len(read)))
        if e.kind is Kind.CONSTANT:
            if read.startswith(e.name, offset):
                return Hit(e.name, e.length)
            if not e.max_edits:
                return None
            got = prefix_align(e.name, read[offset : offset + e.length + e.max_edits], e.max_edits)
            return got and Hit(e.name, *got)
        if not e.barcodes:
            return None
        return self._equal(read, offset) if self.equal_length else self.align_all(self._window(read, offset))

    def _window(self, read: str, offset: int) -> str:
        return read[offset : offset + max(map(len, self.element.barcodes)) + self.element.max_edits]

    def _equal(self, read: str, offset: int) -> Hit | None:
        """Exact, then one substitution, then one insertion or deletion, then alignment."""
        e = self.element
        window = read[offset : offset + e.length]
        if len(window) == e.length:
            if window in self.exact:
                return Hit(window, e.length)
            if not e.max_edits:
                return None
            if window in self.substitutions:
                b = self.substitutions[window]
                return b and Hit(b, e.length, 0, 0, 1)
            if self.options.hamming:
                return None
        elif not e.max_edits:
            return None
        if self.options.precalculate_indels:
            inserted, deleted = self.indels
            more = inserted.get(read[offset : offset + e.length + 1])
            less = deleted.get(read[offset : offset + e.length - 1])
            if more and more != less:
                return Hit(more, e.length + 1, 1, 0, 0)
            if less and less != more:
                return Hit(less, e.length - 1, 0, 1, 0)
            if e.max_edits == 1:
                return None
        return self.align_all(self._window(read, offset))

    def _sharing(self, window: str) -> list[int]:
        """Barcodes with a piece whole in the window, as far from its place as the edits may move it.

        No barcode within the allowed edits is missing: they leave one of the pieces whole.
        """
        k = self.element.max_edits
        found: set[int] = set()
        for start, end, by_letters in self.pieces:
            for at in range(max(0, start - k), start + k + 1):
                found.update(by_letters.get(window[at : at + end - start], ()))
        return sorted(found)

    def _align_all(self, window: str) -> Hit | None:
        """The one barcode nearest to the window's start, by the rules for ties in list order."""
        e, most = self.element, self.options.max_candidates
        tried, near = range(len(e.barcodes)), None
        if len(e.barcodes) > most:
            if not self.equal_length:
                return None
            tried = self._sharing(window)
            near = prefix_distances(self.codes[0][tried], self.codes[1][tried], window)
            if np.count_nonzero(near <= e.max_edits) > most:
                return None
        elif len(e.barcodes) > 8:
            near = prefix_distances(*self.codes, window)
        best: Hit | None = None
        tied, least = False, e.max_edits + 1
        for at, i in enumerate(tried):
            if near is not None and near[at] > min(least, e.max_edits):
                continue
            b = e.barcodes[i]
            got = prefix_align(b, window[: len(b) + e.max_edits], e.max_edits)
            if got is None or sum(got[1:]) > least:
                continue
            hit = Hit(b, *got)
            if not self.equal_length and best is not None and hit.consumed < best.consumed:
                continue  # a shorter piece of read loses, however few its edits
            tied = hit.edits == least and best is not None
            best, least = hit, hit.edits
        return None if tied else best


@dataclass
class Trace:
    """How far a read was matched."""

    hits: list[Hit] = field(default_factory=list)
    covered: int = 0
    complete: bool = True
    failed_at: int | None = None
    dna: str | None = None
    dna_quality: str | None = None

    @property
    def score(self) -> int:
        return sum(h.edits for h in self.hits)


def matchers(elements: Sequence[Element], options: MatchOptions) -> list[Matcher]:
    return [Matcher(e, None, options) for e in elements]


def matchers_of_opposite(elements: Sequence[Element], options: MatchOptions) -> list[Matcher]:
    flipped = reversed_elements(elements)
    return [
        Matcher(f, e.barcodes if e.kind is Kind.LIST else None, options)
        for f, e in zip(flipped, reversed(elements), strict=True)
    ]


def _out(m: Matcher, original: Element | None, hit: Hit) -> Hit:
    """A hit with its barcode as the pattern writes it."""
    if m.element.kind is Kind.LIST and m.emit:
        return Hit(m.emit[hit.barcode], hit.consumed, hit.insertions, hit.deletions, hit.substitutions)
    if m.element.kind is Kind.CONSTANT and original is not None:
        return Hit(original.name, hit.consumed, hit.insertions, hit.deletions, hit.substitutions)
    return hit


def walk(ms: Sequence[Matcher], originals: Sequence[Element], read: str, quality: str, pair: bool, opposite: bool) -> Trace:
    """Matches elements in order until one fails, the read ends, or a stop or separator comes.

    With ``pair`` a read that is used up ends the walk without a failure; ``covered`` counts what
    it covered, stop and separator included unless ``opposite``.
    """
    t, offset = Trace(), 0
    for i, (m, e) in enumerate(zip(ms, originals, strict=True)):
        kind = m.element.kind
        if pair and offset >= len(read) and kind not in (Kind.STOP, Kind.SEPARATOR):
            t.complete = False
            return t
        if kind in (Kind.STOP, Kind.SEPARATOR):
            t.covered += not opposite
            return t
        if kind is Kind.DNA:
            if i + 1 < len(ms) and ms[i + 1].element.kind is not Kind.SEPARATOR:
                raise ValueError("[DNA] must be followed by [-] in reading direction")
            t.dna, t.dna_quality = read[offset:], quality[offset:]
            offset = len(read)
            t.covered += 1
            continue
        if offset > len(read) or kind is not Kind.RANDOM and offset >= len(read):
            t.complete = False
            return t
        hit = m.at(read, offset)
        if hit is None:
            t.complete, t.failed_at = False, i
            return t
        t.hits.append(_out(m, e, hit))
        offset += hit.consumed
        t.covered += 1
    return t


@dataclass
class Match:
    """The outcome of one read under one pattern."""

    ok: bool
    score: int = 0
    hits: list[Hit] = field(default_factory=list)
    dna: str | None = None
    dna_quality: str | None = None
    fail_fw: int | None = None
    fail_rv: int | None = None


class PatternMatcher:
    def __init__(self, pattern: Pattern, options: MatchOptions, mode: str) -> None:
        """``mode`` is "single", "paired" or "independent"."""
        self.pattern, self.mode = pattern, mode
        self.elements = list(pattern.elements)
        if mode == "independent":
            fw, rv = pattern.halves()
            self.fw_elements, self.rv_elements = list(fw), list(rv)
            self.fw, self.rv = matchers(fw, options), matchers(rv, options)
        else:
            self.fw_elements = self.elements
            self.fw = matchers(self.elements, options)
            self.rv_elements = self.elements[::-1]
            self.rv = matchers_of_opposite(self.elements, options) if mode == "paired" else []

    def match(self, seq: str, qual: str, seq_rv: str = "", qual_rv: str = "") -> Match:
        if self.mode == "single":
            t = walk(self.fw, self.fw_elements, seq, qual, False, False)
            return Match(t.complete, t.score, t.hits, t.dna, t.dna_quality, t.failed_at)
        if self.mode == "independent":
            a = walk(self.fw, self.fw_elements, seq, qual, False, False)
            b = walk(self.rv, self.rv_elements, seq_rv, qual_rv, False, False)
            return Match(
                a.complete and b.complete, a.score + b.score, a.hits + b.hits,
                a.dna if a.dna is not None else b.dna, a.dna_quality if a.dna is not None else b.dna_quality,
                a.failed_at, b.failed_at,
            )
        a = walk(self.fw, self.fw_elements, seq, qual, True, False)
        b = walk(self.rv, self.rv_elements, seq_rv, qual_rv, True, True)
        hits = self._joined(a, b)
        dna, quality = (a.dna, a.dna_quality) if a.dna is not None else (b.dna, b.dna_quality)
        score = a.score + b.score
        return Match(hits is not None, score, hits or [], dna, quality, a.failed_at, b.failed_at)

    def _joined(self, a: Trace, b: Trace) -> list[Hit] | None:
        """Both reads' hits as one list in the pattern's order, if together they cover the pattern."""
        n, f, r = len(self.elements), a.covered, b.covered
        forward = dict(zip([i for i in range(f) if self.elements[i].emitted], a.hits, strict=True))
        backward = dict(zip([n - 1 - i for i in range(r) if self.elements[n - 1 - i].emitted], b.hits, strict=True))
        for i in range(n - r, f):  # covered by both
            e = self.elements[i]
            if e.emitted and e.kind is not Kind.RANDOM and forward[i].barcode != backward[i].barcode:
                return None
        gap = {}
        for i in range(f, n - r):  # covered by neither
            e = self.elements[i]
            if e.kind is not Kind.CONSTANT:
                return None
            gap[i] = Hit(e.name, 0)
        every = backward | gap | forward
        return [every[i] for i in range(n) if self.elements[i].emitted]


def best_match(all_patterns: Sequence[PatternMatcher], seq: str, qual: str, seq_rv: str, qual_rv: str) -> tuple[int, Match]:
    """Number and match of the pattern with the fewest edits, the first of equals; -1 if none matches."""
    at, best = -1, Match(False)
    for i, p in enumerate(all_patterns):
        m = p.match(seq, qual, seq_rv, qual_rv)
        if m.ok and (at < 0 or m.score < best.score):
            at, best = i, m
        elif not m.ok and at < 0 and len(all_patterns) == 1:
            best = m
    return at, best
