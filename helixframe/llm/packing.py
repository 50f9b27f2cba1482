"""Best-fit packing by a linear grouping scheme."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, saved, table

CAPACITY = 2048
#: Lengths above this share of the capacity are large: they are grouped; the rest is small.
LARGE = 0.45
#: Groups of equal cardinality that large lengths are rounded up within.
GROUPS = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


@lru_cache(maxsize=1)
def _encoding(json_path: str, ranks_path: str, pattern: str):
    import json

    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(json_path) as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def _encoder(json_path: str, ranks_path: str, pattern: str):
    """Token ids of a text.

    The faster library gives the ids of ``tokenizers``, but its pattern engine refuses some very
    long runs, of white space for one; such a text is encoded by ``tokenizers`` itself.
    """
    fast = _encoding(json_path, ranks_path, pattern)

    def ids(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(_tokenizer(json_path).encode(text, add_special_tokens=False).ids, np.int64)

    return ids


@lru_cache(maxsize=1)
def _tokenizer(json_path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path)


def _cut(tokenizer: tuple[str, str, str], capacity: int, end_id: int):
    """Pieces of each document; in each partition they are numbered within their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = _encoder(*tokenizer)
        part = TaskContext.get().partitionId()
        places = np.zeros(capacity + 1, np.int64)
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                first = len(ids) % capacity or capacity
                at, piece = 0, 0
                while at < len(ids):
                    n = first if at == 0 else capacity
                    row = (doc_id, piece, at, n, zlib.crc32(ids[at : at + n].tobytes()), part, int(places[n]))
                    for column, x in zip(out, row, strict=True):
                        column.append(x)
                    places[n] += 1
                    at, piece = at + n, piece + 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"],
            )

    return run


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best multiset of ``sizes`` within ``capacity``: its value, and how often each is used."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    low = int(sizes.min())
    for c in range(low, capacity + 1):
        if best[c - 1] > best[c]:
            best[c], last[c] = best[c - 1], -2
        fit = sizes <= c
        got = best[c - sizes[fit]] + values[fit]
        i = int(np.argmax(got))
        if got[i] > best[c] + 1e-12:
            best[c], last[c] = got[i], np.flatnonzero(fit)[i]
    used, c = np.zeros(len(sizes), np.int64), capacity
    while c >= low and last[c] != -1:
        if last[c] == -2:
            c -= 1
        else:
            used[last[c]] += 1
            c -= int(sizes[last[c]])
    return float(best[capacity]), used


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Configurations of few sizes, and how often to use each, for nearly the fewest sequences.

    Solves the linear programme of the cutting-stock problem by column generation with a revised
    simplex, and rounds down; what is left of the demand is not covered here.
    """
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)  # a column per configuration
    x = demand / np.diag(basis)
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(k))
        value, column = _knapsack(sizes, np.maximum(price, 0), capacity)
        if value <= 1 + 1e-7:
            break
        d = np.linalg.solve(basis, column.astype(float))
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        out = int(np.argmin(ratio))
        x = x - ratio[out] * d
        x[out] = ratio[out]
        x = np.maximum(x, 0)
        basis[:, out] = column
    left, chosen = demand.copy(), []
    for j in np.argsort(-x):
        column = basis[:, j].astype(np.int64)
        m = int(x[j] + 1e-9)
        used = column > 0
        m = min(m, int((left[used] // column[used]).min()))
        if m > 0:
            chosen.append((column, m))
            left -= m * column
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> list[tuple[list[int], int]]:
    """Sequences as (lengths in it, how many such sequences), from how often each length occurs.

    Large lengths are rounded up to the greatest of their group; configurations of the rounded
    sizes are chosen by ``configurations``; each slot then takes the greatest actual length that
    leaves room for the rest, which splits a configuration where a length runs out. Room is counted with
    actual lengths from there on, and all lengths not placed yet, the small ones among them, go
    greatest first into the fullest sequences that take them. All work is on counts by length, at
    most ``capacity`` of them, whatever the number of documents.
    """
    count = np.zeros(capacity + 1, np.int64)
    for n, c in histogram.items():
        count[n] += c
    out = [([capacity], int(count[capacity]))] if count[capacity] else []
    count[capacity] = 0
    big = np.arange(int(large * capacity) + 1, capacity)
    big = big[count[big] > 0]
    templates: list[list] = []
    if len(big):
        total = int(count[big].sum())
        before = np.cumsum(count[big]) - count[big]
        group = before * groups // total  # equal cardinality, up to ties of a length
        if len(big) <= groups:  # few lengths need no rounding
            group = np.arange(len(big))
        tops = np.unique(group)
        sizes = np.array([big[group == g].max() for g in tops])
        demand = np.array([int(count[big[group == g]].sum()) for g in tops])
        left = count.copy()  # large lengths not placed yet
        left[: big[0]] = 0
        for column, m in configurations(sizes, demand, capacity):
            slots = sorted((int(sizes[g]) for g in range(len(tops)) for _ in range(int(column[g]))), reverse=True)
            while m:
                # each slot takes the greatest length that leaves room for the slots behind it
                picks: list[int] = []
                need: dict[int, int] = {}
                for j in range(len(slots)):
                    most = capacity - sum(picks) - sum(slots[j + 1 :])
                    free = left[: most + 1] > 0
                    for n, k in need.items():
                        if n <= most:
                            free[n] = left[n] > k
                    at = np.flatnonzero(free)
                    if len(at):
                        n = int(at[-1])
                        picks.append(n)
                        need[n] = need.get(n, 0) + 1
                if not picks:
                    break
                run = min(m, *(int(left[n]) // k for n, k in need.items()))
                for n, k in need.items():
                    left[n] -= run * k
                    count[n] -= run * k
                templates.append([picks, run])
                m -= run
    room: list[list[list]] = [[] for _ in range(capacity + 1)]  # open sequences by what they have left
    for lengths, n in templates:
        room[capacity - sum(lengths)].append([lengths, n])
    for length in range(capacity, 0, -1):
        free = length
        while count[length]:
            while free <= capacity and not room[free]:
                free += 1
            if free > capacity:  # none takes it: open as many as it fills
                per = capacity // length
                full, rest = divmod(int(count[length]), per)
                if full:
                    room[capacity - per * length].append([[length] * per, full])
                if rest:
                    room[capacity - rest * length].append([[length] * rest, 1])
                count[length] = 0
                break
            lengths, n = room[free].pop()
            take = min(n, int(count[length]))
            if take < n:
                room[free].append([lengths, n - take])
            room[free - length].append([[*lengths, length], take])
            count[length] -= take
            if free - length >= length:
                free = length
    return out + [(lengths, n) for r in room for lengths, n in r]


def slots_of(packed: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first rank, offset), by length and rank."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in packed:
        offset = 0
        for length in lengths:
            r = rank.get(length, 0)
            rows.append((length, r, r + n - 1, sequence, offset))
            rank[length], offset = r + n, offset + length
        sequence += n
    return sorted(rows)


def pack_documents(
    docs: DataFrame, json_path: str, ranks_path: str, pattern: str, capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """Packs all texts of ``docs`` (doc_id, text) into few sequences of ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece. A text is
    its tokens and ``end_id``; a null text is empty, so it is ``end_id`` alone. Only documents
    longer than ``capacity`` are cut, and their first piece is the short one. Repeated rows are
    packed each on its own.

    The tokens are those of the tokenizer in ``json_path``; ``ranks_path`` holds the same
    vocabulary for the faster of two libraries, whose results are the same. Texts that it refuses
    (runs of a million blanks) are encoded by the other one. Other columns are ignored; an empty
    table gives no pieces; pieces of a null doc_id keep it.

    Which lengths share a sequence is planned from their counts alone (``plan``), at most
    ``capacity`` numbers. Pieces are ranked within their length by partition and place in it,
    and the rank says which slot of the plan a piece takes.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    pieces = saved(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _cut((json_path, ranks_path, pattern), capacity, end_id), PIECES
        ),
        "pieces",
    )
    per_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    per_length = {r.length: r.n for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = slots_of(plan(per_length, capacity))
    keys = np.array([(r[0] << 44) + r[1] for r in rows], np.int64)
    first = np.array([r[1] for r in rows], np.int64)
    sequences = np.array([r[3] for r in rows], np.int64)
    offsets = np.array([r[4] for r in rows], np.int64)
    from pyspark.sql import Window

    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = per_part.select("length", "part", F.coalesce(before, F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("rank")
    )
    slots = spark.sparkContext.broadcast((keys, first, sequences, offsets))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, first, sequences, offsets = slots.value
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(keys, (length.astype(np.int64) << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequences[at] + rank - first[at]), pa.array(offsets[at])],
                [*b.schema.names[:5], "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def pack_with_public_tokenizer(docs: DataFrame) -> DataFrame:
    """``pack_documents`` with the public byte-level tokenizer of 50,257 ids."""
    import public_tokenizers as p

    return pack_documents(docs, p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_with_public_tokenizer(table(spark, sf_dir, "documents"))
