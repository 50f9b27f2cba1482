"""Vectorised hashing of the words of Arrow string batches, in bounded memory."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 17
_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(256, _BASE, np.uint64), dtype=np.uint64)

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: White space of ASCII; and all of ASCII but letters and digits.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = True
NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = False


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _chunk(data: np.ndarray, first: np.ndarray, gaps: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~gaps[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    begins = np.flatnonzero(start[at])
    lengths = np.diff(begins, append=len(at))
    place = np.arange(len(at)) - np.repeat(begins, lengths)
    global _POWERS
    if (most := int(lengths.max())) > len(_POWERS):
        _POWERS = np.cumprod(np.full(most * 2, _BASE, np.uint64), dtype=np.uint64)
    h = np.add.reduceat(codes[data[at]] * _POWERS[place], begins)
    if len(_POWERS) > CHUNK:
        _POWERS = _POWERS[:256].copy()
    return mix(h + lengths.astype(np.uint64)), at[begins]


def word_hashes(column: pa.Array, gaps: np.ndarray = SPACE, fold: np.ndarray = FOLD) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs of bytes not in ``gaps``), and where each text's words begin.

    The second array has one entry more than there are texts. Works through the bytes in chunks
    of about CHUNK bytes, cut where a text or a word ends.
    """
    data, bounds = raw(column)
    codes = _BYTE[fold]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    hashes, places, lo = [], [], 0
    while lo < len(data):
        hi = min(len(data), lo + CHUNK)
        while hi < len(data):  # on to the next end of a word or text
            near = gaps[data[hi : hi + 4096]] | first[hi : hi + len(data[hi : hi + 4096])]
            if near.any():
                hi += int(np.argmax(near))
                break
            hi = min(len(data), hi + 4096)
        h, p = _chunk(data[lo:hi], first[lo:hi], gaps, codes)
        hashes.append(h)
        places.append(p + lo)
        lo = hi
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    p = np.concatenate(places) if places else np.zeros(0, np.int64)
    return h, np.searchsorted(p, bounds)


def shape_hashes(kinds: np.ndarray, bounds: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """Hashes of words spelt in ``kinds`` of characters, a run of one kind within a word taken once."""
    keep = np.ones(len(kinds), bool)
    keep[1:] = kinds[1:] != kinds[:-1]
    first = np.zeros(len(kinds) + 1, bool)
    first[bounds] = True
    first = first[:-1]
    keep |= first
    return _chunk(kinds[keep], first[keep], gaps, _BYTE)[0]


def shingles(words: np.ndarray, bounds: np.ndarray, n: int = 5):
    """Sorted distinct shingle hashes (int64) of each text: runs of ``n`` words, or all of fewer."""
    weights = mix(np.arange(1, n + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
    many = len(words) - n + 1
    runs = sum((words[j : j + many] * weights[j] for j in range(n)), np.zeros(many, np.uint64)) if many > 0 else None
    if runs is not None:
        runs = mix(runs).view(np.int64)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(runs[a : b - n + 1])
        elif b > a:
            m = b - a
            yield mix(np.array([(words[a:b] * weights[:m]).sum() + np.uint64(m)], np.uint64)).view(np.int64)
        else:
            yield np.zeros(0, np.int64)
