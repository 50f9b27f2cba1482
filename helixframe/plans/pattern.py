"""Patterns: what a read is made of, element by element."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from enum import Enum

from ..functions.seq import revcomp_text


class Kind(Enum):
    CONSTANT = "constant"
    LIST = "list"
    RANDOM = "random"
    STOP = "*"
    SEPARATOR = "-"
    DNA = "DNA"


@dataclass(frozen=True)
class Element:
    kind: Kind
    name: str
    max_edits: int = 0
    length: int = 0
    barcodes: tuple[str, ...] = ()

    @property
    def emitted(self) -> bool:
        """Whether it gives a barcode column."""
        return self.kind in (Kind.CONSTANT, Kind.LIST, Kind.RANDOM)

    @property
    def equal_length(self) -> bool:
        return len({len(b) for b in self.barcodes}) == 1


@dataclass(frozen=True)
class Pattern:
    name: str
    elements: tuple[Element, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [e.name for e in self.elements if e.emitted]

    @property
    def has_dna(self) -> bool:
        return any(e.kind is Kind.DNA for e in self.elements)

    def halves(self) -> tuple[tuple[Element, ...], tuple[Element, ...]]:
        """Elements before and behind the read separator."""
        kinds = [e.kind for e in self.elements]
        if Kind.SEPARATOR not in kinds:
            raise ValueError(f"pattern {self.name} has no [-], which independent reads need")
        at = kinds.index(Kind.SEPARATOR)
        return self.elements[:at], self.elements[at + 1 :]


def parse_list(text: str, multi_line: bool = False, trim: bool = True) -> list[str]:
    """A comma-separated list; over several lines only with ``multi_line``."""
    lines = text.split("\n")
    while lines and not lines[-1]:
        lines.pop()
    if len(lines) > 1 and not multi_line:
        raise ValueError("a list must stand on one line")
    out: list[str] = []
    for line in lines:
        parts = line.removesuffix("\r").split(",")
        if parts and not parts[-1].strip():
            parts.pop()
        out += [p.strip() if trim else p for p in parts]
    return out


def parse_barcodes(text: str, multi_line: bool = False) -> tuple[str, ...]:
    out = parse_list(text, multi_line)
    for b in out:
        if not b or set(b) - set("ACGT"):
            raise ValueError(f"not a barcode of ACGT: {b!r}")
    return tuple(out)


def split_pattern(line: str, number: int) -> tuple[str, list[str]]:
    """Name and element texts of a line such as NAME:[ACGT][10X][list.txt]."""
    line = line.strip()
    if line.count(":") > 1:
        raise ValueError(f"more than one colon: {line}")
    name, colon, rest = line.partition(":")
    if not colon:
        name, rest = f"PATTERN_{number}", line
    elif "[" not in rest:
        raise ValueError(f"a name without a pattern: {line}")
    parts, at = [], 0
    while (begin := rest.find("[", at)) >= 0:
        end = rest.find("]", begin)
        if end < 0:
            raise ValueError(f"a bracket isn't closed: {line}")
        if text := rest[begin + 1 : end].strip():
            parts.append(text)
        at = end + 1
    return name.strip(), parts


def make_element(text: str, max_edits: int, load: Callable[[str], str | None]) -> Element:
    """Constants first, then files, then lengths, DNA, stop and separator; the first that fits."""
    if text and not set(text) - set("ACGT"):
        return Element(Kind.CONSTANT, text, max_edits, len(text))
    if text == "DNA":
        return Element(Kind.DNA, text)
    if text == "*":
        return Element(Kind.STOP, text)
    if text == "-":
        return Element(Kind.SEPARATOR, text)
    if text[:1].isdigit() and text[-1:] in "xX" and text[:-1].isdigit():
        return Element(Kind.RANDOM, text[:-1] + "X", 0, int(text[:-1]))
    if (content := load(text)) is not None:
        barcodes = parse_barcodes(content)
        length = len(barcodes[0]) if barcodes and len({len(b) for b in barcodes}) == 1 else 0
        return Element(Kind.LIST, text.rsplit("/", 1)[-1], max_edits, length, barcodes)
    raise ValueError(f"not an element: [{text}]")


def parse_mismatches(text: str) -> list[list[int]]:
    rows = [line for line in text.split("\n") if line.strip()]
    out = []
    for line in rows:
        parts = [p.strip() for p in line.split(",")]
        if parts and not parts[-1]:
            parts.pop()
        if not all(p.isdigit() for p in parts):
            raise ValueError(f"not numbers: {line}")
        out.append([int(p) for p in parts])
    return out


def parse_patterns(patterns: str, mismatches: str, load: Callable[[str], str | None]) -> list[Pattern]:
    """Patterns of a pattern file, with the allowed edits of a mismatch file line by line.

    ``load`` returns the text of a whitelist file, or None where there is none.
    """
    lines = [line for line in patterns.split("\n") if line]
    allowed = parse_mismatches(mismatches)
    if len(allowed) != len(lines):
        raise ValueError(f"{len(lines)} patterns but {len(allowed)} lines of mismatches")
    out: list[Pattern] = []
    for number, (line, edits) in enumerate(zip(lines, allowed, strict=True)):
        name, parts = split_pattern(line, number)
        if len(parts) != len(edits):
            raise ValueError(f"{name}: {len(parts)} elements but {len(edits)} mismatches")
        out.append(Pattern(name, tuple(make_element(p, k, load) for p, k in zip(parts, edits, strict=True))))
    if len({p.name for p in out}) < len(out):
        raise ValueError("pattern names must be unique")
    return out


def combined(patterns: Sequence[Pattern]) -> Pattern:
    """The pattern whose columns hold all of ``patterns``: lists side by side under a joint name.

    Needs the same kinds of elements at the same places. A list that all share stays as it is;
    others are laid end to end, once each, in the patterns' order.
    """
    first = patterns[0]
    kinds = [e.kind for e in first.elements]
    if any([e.kind for e in p.elements] != kinds for p in patterns):
        raise ValueError("combined patterns need equal kinds of elements")
    elements = []
    for own in zip(*(p.elements for p in patterns), strict=True):
        if own[0].kind is not Kind.LIST:
            elements.append(own[0])
            continue
        unique = list({e.name: e for e in own}.values())
        barcodes = tuple(b for e in unique for b in e.barcodes)
        name = "&".join(e.name.removesuffix(".txt") for e in unique)
        name = unique[0].name if len(unique) == 1 else f"{name}.txt"
        lengths = {len(b) for b in barcodes}
        elements.append(replace(own[0], name=name, barcodes=barcodes, length=lengths.pop() if len(lengths) == 1 else 0))
    return Pattern(first.name, tuple(elements))


def reversed_elements(elements: Sequence[Element]) -> list[Element]:
    """Elements from the last to the first as they stand on the opposite strand."""
    out = []
    for e in reversed(elements):
        if e.kind is Kind.CONSTANT:
            out.append(replace(e, name=revcomp_text(e.name)))
        elif e.kind is Kind.LIST:
            out.append(replace(e, barcodes=tuple(revcomp_text(b) for b in e.barcodes)))
        else:
            out.append(e)
    return out


def conversion_rates(barcodes: Sequence[str], most: int = 500) -> dict[str, int]:
    """Each barcode's least prefix distance to another one, for lists of under ``most``."""
    import numpy as np

    from ..functions.align import prefix_distances

    if len(barcodes) < 2 or len(barcodes) >= most:
        return {}
    width = max(map(len, barcodes))
    codes = np.array([list(b.ljust(width, "\0").encode()) for b in barcodes], np.uint8)
    lengths = np.array([len(b) for b in barcodes])
    out = {}
    for i, b in enumerate(barcodes):
        d = prefix_distances(codes, lengths, b)
        d[i] = np.iinfo(np.int64).max
        out[b] = int(d.min())
    return out
