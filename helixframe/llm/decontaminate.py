"""Benchmark decontamination by latent semantic retrieval."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, saved, table, without
from .texthash import NOT_ALNUM, mix, word_hashes

#: Hashed terms, columns of the random test matrix, latent dimensions.
TERMS, SKETCH, RANK = 1 << 14, 48, 40
#: Words of a passage that the space is fitted on.
PASSAGE = 256
#: Words of a step; windows begin and end with steps.
STEP = 4
#: Least cosine of an item and a window for the window to be a candidate.
COSINE = 0.3
#: Least share of an item's words that the longest common subsequence holds.
COMMON = 0.65
#: Of an item's rarest words (its answer words), so many at most, and the least share a passage must hold.
ANSWER, ANSWERED = 5, 0.6
#: Items of fewer words than this are all answer; they are found where all their words stand in a row.
SHORT = ANSWER + 1
#: Words of all items that one pass over the documents searches for.
ITEM_WORDS = 400_000
#: Words, or cosines and candidates times 64, worked on at once.
SLICE = 1 << 15
#: Bits of a word's hash that most words are told apart from answer words by.
SIEVE = 20


def _test_matrix() -> tuple[np.ndarray, np.ndarray]:
    h = mix(np.arange(TERMS, dtype=np.uint64) + np.uint64(77))
    return (h % np.uint64(SKETCH)).astype(np.int64), np.where(h >> np.uint64(40) & np.uint64(1), 1.0, -1.0)


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per term: passages with it, and its row of A'(A W), A counting terms by passage.

    W has one sign in each row, in a column given by the term's hash, so that A W is one count.
    """
    column, sign = _test_matrix()
    out, df, total = np.zeros((TERMS, SKETCH)), np.zeros(TERMS, np.int64), 0
    for b in batches:
        words, bounds = word_hashes(b.column("text"), NOT_ALNUM)
        terms = (words % np.uint64(TERMS)).astype(np.uint16)
        inside = np.arange(len(terms)) - np.repeat(bounds[:-1], np.diff(bounds))
        passage = np.cumsum(inside % PASSAGE == 0) - 1
        lo = 0
        while lo < len(terms):
            hi = lo + SLICE
            if hi < len(terms):  # to the end of a passage
                hi = lo + int(np.searchsorted(passage[lo:], passage[hi]))
            hi = min(hi, len(terms))
            t, p = terms[lo:hi], passage[lo:hi] - passage[lo]
            n = int(p[-1]) + 1
            y = np.bincount(p * SKETCH + column[t], weights=sign[t], minlength=n * SKETCH).reshape(n, SKETCH).astype(np.float32)
            order = np.argsort(t, kind="stable")
            t, p = t[order], p[order]
            first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
            out[t[first]] += np.add.reduceat(y[p], first, axis=0)
            df += np.bincount(t[np.append(True, (t[1:] != t[:-1]) | (p[1:] != p[:-1]))], minlength=TERMS)
            total += n
            lo = hi
    seen = np.flatnonzero(df)
    rows = pa.FixedSizeListArray.from_arrays(pa.array(out[seen].astype(np.float32).ravel()), SKETCH).cast(pa.list_(pa.float32()))
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(df[seen]), rows], ["term", "df", "row"])
    none = pa.array([[0.0] * SKETCH], pa.list_(pa.float32()))
    yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([total]), none], ["term", "df", "row"])


def fit_space(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Passages with each term, and each term's place in the latent space.

    One pass over all texts: a randomised SVD of the passages' TF-IDF matrix D = A I from the
    sketch Y = A'(A W). With the test matrix W / I, D'D (W / I) is I Y, from which the Nystroem
    form of D'D gives singular vectors and values. Places are divided by the singular values, so
    that a passage's place is its row of the left singular vectors. Tasks send TERMS rows at most,
    whatever they read; the sums are of fixed size and go to the driver.
    """
    rows = docs.select("text").mapInArrow(_passages, "term long, df long, row array<float>")
    cells = [F.sum(F.col("row")[j].cast("double")).alias(f"c{j}") for j in range(SKETCH)]
    got = rows.groupBy("term").agg(F.sum("df").alias("df"), *cells).toArrow()
    term = got.column("term").to_numpy()
    df, y = np.zeros(TERMS), np.zeros((TERMS, SKETCH))
    real = term >= 0
    total = float(got.column("df").to_numpy()[~real].sum())
    df[term[real]] = got.column("df").to_numpy()[real]
    y[term[real]] = np.stack([got.column(f"c{j}").to_numpy()[real] for j in range(SKETCH)], axis=1)
    idf = 1 + np.log((1 + total) / (1 + df))
    column, sign = _test_matrix()
    core = np.zeros((SKETCH, SKETCH))
    np.add.at(core, column, sign[:, None] * y)
    w, v = np.linalg.eigh((core + core.T) / 2)
    w = np.maximum(w, max(w.max(), 1e-9) * 1e-9)
    u, s, _ = np.linalg.svd((idf[:, None] * y) @ (v / np.sqrt(w)), full_matrices=False)
    s = np.maximum(s[:RANK], max(s[0], 1e-9) * 0.3)
    return df, (idf[:, None] * u[:, :RANK] / s).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _places(x: list[int]) -> dict[int, int]:
    """Per word: the places it has in ``x``, a bit each."""
    where: dict[int, int] = {}
    for i, w in enumerate(x):
        where[w] = where.get(w, 0) | 1 << i
    return where


def _common(n: int, masks: list[int]) -> int:
    """Length of the longest common subsequence of a text of ``n`` words and words given by their places in it."""
    full = (1 << n) - 1
    row = full
    for mask in masks:
        m = row & mask
        row = ((row + m) | (row - m)) & full
    return n - row.bit_count()


def longest_common(x: list[int], y: list[int]) -> int:
    """Length of the longest common subsequence, a word of ``x`` a bit."""
    where = _places(x)
    return _common(len(x), [where[w] for w in y if w in where])


def _steps(n: int) -> int:
    """Steps of the windows that an item of ``n`` words is compared with: its own, to two binary places."""
    steps = max(2, round(n / STEP))
    unit = max(1, (1 << steps.bit_length()) >> 3)
    return round(steps / unit) * unit


def _queries(items: list[tuple[int, np.ndarray]], df: np.ndarray, space: np.ndarray) -> dict:
    """What is searched for: items by their place in the latent space, and short items by all their words."""
    short: dict[int, tuple[list[int], list[int]]] = {}
    by_steps: dict[int, list[int]] = {}
    answers = []
    for k, (_, words) in enumerate(items):
        n = len(words)
        rare = np.argsort(df[(words % np.uint64(TERMS)).astype(np.int64)], kind="stable")
        answers.append({int(words[i]) for i in rare[:ANSWER]})
        if n < SHORT:
            keys, own = short.setdefault(n, ([], []))
            keys.append(_gram(words, n)[0])
            own.append(k)
        else:
            by_steps.setdefault(_steps(n), []).append(k)
    place = lambda k: space[(items[k][1] % np.uint64(TERMS)).astype(np.int64)].sum(axis=0)
    listed = np.zeros((len(items), ANSWER), np.uint64)
    for k, own in enumerate(answers):
        listed[k] = [*own, *[next(iter(own))] * (ANSWER - len(own))]
    sizes = np.array([len(w) for _, w in items], np.int64)
    span = sizes + 2 * (sizes // 4 + 1)  # an item's words, and room on both sides for words that were put in
    held = np.array([math.ceil(ANSWERED * len(a) - 1e-9) for a in answers], np.int64)
    return {
        "ids": [i for i, _ in items], "words": [w for _, w in items], "answers": answers, "listed": listed,
        "space": np.append(space, np.zeros((1, RANK), np.float32), axis=0),
        "sought": {
            m: (np.array(own), _unit(np.array([place(k) for k in own])), int(span[own].max()) // 2, int(held[own].min()))
            for m, own in sorted(by_steps.items())
        },
        "span": span, "held": held,
        "short": {n: (np.array(sorted(set(keys)), np.uint64), list(zip(keys, own, strict=True))) for n, (keys, own) in short.items()},
    }


def _gram(words: np.ndarray, n: int) -> np.ndarray:
    many = len(words) - n + 1
    h = np.zeros(max(many, 0), np.uint64)
    for j in range(n if many > 0 else 0):
        h = mix(h + words[j : j + many])
    return h


def _near(words: np.ndarray, rare: np.ndarray, q: dict) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(first words of windows, items, words of a window) where the cosine is COSINE or more.

    Windows of each number of steps begin a quarter of their length apart, so one is never further
    than an eighth from a passage. Cosines are exact, in blocks of windows by all items of that
    length. Windows that can't pass the answer check of any of these items, as too few answer
    words of any item (``rare``, summed up) stand in or by them, are left out.
    """
    longest = max(q["sought"], default=0)
    steps = len(words) // STEP + 1  # the last one may be short
    per = max(SLICE // 4 // STEP, 4 * longest)
    for lo in range(0, steps if longest else 0, per):
        sums = None
        for m, (own, vectors, room, held) in q["sought"].items():
            apart = max(1, m // 4)
            at = np.arange(lo + -lo % apart, min(steps, lo + per), apart)
            first, last = np.maximum(at * STEP - room, 0), np.minimum((at + m) * STEP + room, len(words))
            at = at[rare[np.maximum(first, last)] - rare[first] >= held] - lo
            if not len(at):
                continue
            if sums is None:
                part = words[lo * STEP : (lo + per + longest) * STEP]
                terms = np.full(-(-len(part) // STEP) * STEP, TERMS)  # the row of a word that isn't there is zero
                terms[: len(part)] = part % np.uint64(TERMS)
                sums = np.zeros((len(terms) // STEP + 1, RANK))
                np.cumsum(sum(q["space"][terms[j::STEP]] for j in range(STEP)), axis=0, out=sums[1:])
            z = (sums[np.minimum(at + m, len(sums) - 1)] - sums[np.minimum(at, len(sums) - 1)]).astype(np.float32)
            z *= (1 / np.maximum(np.sqrt(np.einsum("ij,ij->i", z, z)), 1e-9))[:, None]
            rows = max(1, SLICE * 64 // len(own))
            for a in range(0, len(at), rows):
                w, x = np.divmod(np.flatnonzero(z[a : a + rows] @ vectors.T >= COSINE), len(own))
                for c in range(0, len(w), SLICE * 4):
                    yield (at[a + w[c : c + SLICE * 4]] + lo) * STEP, own[x[c : c + SLICE * 4]], m * STEP


def _candidates(words: np.ndarray, bounds: np.ndarray, q: dict, sieve: np.ndarray) -> list[tuple[int, int]]:
    """(document, item) where a window near the item in the latent space has enough of its answer words in or by it."""
    rare = np.append(0, np.cumsum(sieve[(words & np.uint64((1 << SIEVE) - 1)).astype(np.int64)]))
    found = []
    for at, item, size in _near(words, rare, q):
        doc = np.searchsorted(bounds, np.minimum(at + size // 2, len(words) - 1), side="right") - 1
        room = q["span"][item] // 2
        lo, hi = np.maximum(at - room, bounds[doc]), np.minimum(at + size + room, bounds[doc + 1])
        ok = np.flatnonzero(rare[hi] - rare[lo] >= q["held"][item])
        for a in range(0, len(ok), SLICE // 8):
            part = ok[a : a + SLICE // 8]
            i, first, last = item[part], lo[part], hi[part]
            inside = first[:, None] + np.arange(int((last - first).max()))
            text = np.where(inside < last[:, None], words[np.minimum(inside, len(words) - 1)], np.uint64(0))
            held = sum(((text == q["listed"][i, j][:, None]).any(axis=1) & ~(q["listed"][i, :j] == q["listed"][i, j][:, None]).any(axis=1)).astype(np.int64) for j in range(ANSWER))
            part = part[held >= q["held"][i]]
            found.append((doc[part] << 32) | item[part])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return list(zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist(), strict=True))


def _ranges(words: np.ndarray, places: list[int], held: int, span: int) -> list[list[int]]:
    """First and last places where spans with ``held`` different answer words begin, apart from each other."""
    out: list[list[int]] = []
    inside: dict[int, int] = {}
    j = 0
    for at in places:
        while j < len(places) and len(inside) < held:
            w = int(words[places[j]])
            inside[w] = inside.get(w, 0) + 1
            j += 1
        if len(inside) < held:
            break
        if places[j - 1] - at < span:
            if out and places[j - 1] - span + 1 <= out[-1][1] + 1:
                out[-1][1] = at
            else:
                out.append([places[j - 1] - span + 1, at])
        w = int(words[at])
        inside[w] -= 1
        if not inside[w]:
            del inside[w]
    return out


def _best(words: np.ndarray, lo: int, hi: int, places: list[int], k: int, q: dict, where: dict[int, int]) -> tuple[int, float] | None:
    """Greatest (common words, share of answer words) of the spans of a document, words lo to hi, that hold item k.

    Every span that begins at a word of the item is tried, but those that can't reach the best so
    far: from one span to a later one the common words grow by the item's words that come in at most.
    """
    n, span, answers = len(q["words"][k]), int(q["span"][k]), q["answers"][k]
    best: tuple[int, float] | None = None
    least = math.ceil(COMMON * n - 1e-9)
    for first, last in _ranges(words, places, int(q["held"][k]), span):
        first = max(first, lo)
        text = words[first : min(hi, last + span)].tolist()
        at = [i for i, w in enumerate(text) if w in where]
        masks = [where[text[i]] for i in at]
        i = end = 0
        while i < len(at) and at[i] <= last - first:
            while end < len(at) and at[end] < at[i] + span:
                end += 1
            common = _common(n, masks[i:end]) if end - i >= least else end - i
            if common >= least:
                held = len(answers.intersection(text[at[i] : at[i] + span])) / len(answers)
                if held >= ANSWERED and (best is None or (common, held) > best):
                    best, least = (common, held), common
                    if best == (n, 1.0):
                        return best
                i += 1
                continue
            to = end + least - common
            if to > len(at):
                break
            i += 1
            while at[i] + span <= at[to - 1]:
                i += 1
    return best


def _search(query):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = query.value
        lengths = np.array([len(w) for w in q["words"]], np.int64)
        wheres: dict[int, dict[int, int]] = {}
        sieve = np.zeros(1 << SIEVE, bool)
        sieve[(q["listed"].ravel() & np.uint64((1 << SIEVE) - 1)).astype(np.int64)] = True
        for b in batches:
            words, bounds = word_hashes(b.column("text"), NOT_ALNUM)
            best: dict[tuple[int, int], tuple[int, float]] = {}
            for d, k in _candidates(words, bounds, q, sieve):
                if k not in wheres:
                    wheres[k] = _places(q["words"][k].tolist())
                places = (np.flatnonzero(np.isin(words[bounds[d] : bounds[d + 1]], q["listed"][k])) + bounds[d]).tolist()
                got = _best(words, int(bounds[d]), int(bounds[d + 1]), places, k, q, wheres[k])
                if got:
                    best[d, k] = got
            for n, (keys, own) in q["short"].items():
                grams = _gram(words, n)
                for at in np.flatnonzero(np.isin(grams, keys)).tolist():
                    d = int(np.searchsorted(bounds, at, side="right")) - 1
                    if bounds[d + 1] >= at + n:
                        for key, k in own:
                            if key == grams[at]:
                                best[d, k] = n, 1.0
            if best:
                rows = sorted(best.items())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(c).take(pa.array([d for (d, _), _ in rows])) for c in ("doc_id", "key")),
                        pa.array([q["ids"][k] for (_, k), _ in rows], pa.int64()),
                        pa.array([c for _, (c, _) in rows], pa.int64()),
                        pa.array([int(lengths[k]) for (_, k), _ in rows], pa.int64()),
                        pa.array([h for _, (_, h) in rows], pa.float64()),
                    ],
                    ["doc_id", "key", "item_id", "common_words", "item_words", "answer_share"],
                )

    return run


FOUND = "doc_id long, key binary, item_id long, common_words long, item_words long, answer_share double"


def passage_counts(docs: DataFrame) -> np.ndarray:
    """Passages that hold each term."""
    return fit_space(docs)[0]


def _found(docs: DataFrame, items: DataFrame) -> DataFrame:
    """FOUND for ``docs`` (doc_id, key, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    counts, space = fit_space(docs)
    out = None
    block: list[tuple[int, np.ndarray]] = []
    size = 0

    def flush() -> None:
        nonlocal out, block, size
        found = docs.mapInArrow(_search(spark.sparkContext.broadcast(_queries(block, counts, space))), FOUND)
        out = found if out is None else out.unionByName(found)
        block, size = [], 0

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and length(text) > 0")
    for r in rows.toLocalIterator():
        words, _ = word_hashes(pa.array([r.text]), NOT_ALNUM)
        if len(words):
            block.append((r.item_id, words))
            size += len(words)
        if size >= ITEM_WORDS:
            flush()
    if block or out is None:
        flush()
    return out


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, common_words, item_words, answer_share, score): documents that hold an item.

    Texts are runs of letters and digits, A to Z lower-cased. Windows of every whole document, as
    long as an item (to two binary places), are placed in the latent space of ``fit_space`` and
    compared with the item by exact cosines in blocks; those of COSINE or more that have
    ``ANSWERED`` of the item's rarest words in or by them are candidates (windows with too few
    rare words of any item, which can't pass that, are not compared). A document holds the
    item when a passage of it does: its longest common subsequence of words has ``COMMON`` of the
    item's words (score is that share) and ``ANSWERED`` of its rarest words stand in it. A passage
    has as many words as the item and half of that (and two) more, for words that were put in; the
    greatest common subsequence of a document's passages counts. Items of no more than ``ANSWER``
    words are all answer and are found where all their words stand in a row.

    One row per row of ``docs`` and item, so rows that repeat a doc_id, or have none, are searched
    each for itself. Null or empty texts hold nothing; null or empty items, and items without an
    id, are in nothing. Other columns are ignored. Items are searched for in blocks of ITEM_WORDS
    words, a pass over the documents each, so what is broadcast is bounded however many there are.
    No shuffle but the one of the space's fixed-size sums.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("key"), "text")
    return _found(docs, items).drop("key").withColumn("score", F.col("common_words") / F.col("item_words"))


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns stay.

    A row is known by its doc_id and its text, so other rows of the same id, or of no id, stay.
    """
    key = {"__helix_id": F.col("doc_id").cast("long"), "__helix_key": F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))}
    keyed = docs.withColumns(key)
    rows = keyed.select(F.col("__helix_id").alias("doc_id"), F.col("__helix_key").alias("key"), "text")
    leaks = _found(rows, items).select(F.col("doc_id").alias("__helix_id"), F.col("key").alias("__helix_key")).distinct()
    return without(keyed, saved(leaks, "leaks"), list(key)).drop(*key)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
