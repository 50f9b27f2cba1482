"""Quality classifier: nearest-neighbour voting in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, table
from .texthash import mix, raw, shape_hashes, word_hashes

#: Hashed terms of a kind (shapes of words, words), and of both.
KIND = 1 << 12
TERMS = 2 * KIND
#: Weight of words beside shapes, whose part of a vector is of length 1.
LEXICAL = 0.5
#: Latent dimensions.
RANK = 32
#: Labelled rows that the classifier is fitted on, at most: those with the smallest hash of doc_id.
SAMPLE = 4096
#: Neighbours that vote.
NEIGHBOURS = 25
#: Documents whose cosines with the sample are worked out at once.
ROWS = 256

#: Bytes by kind: letters in lower case and all beyond ASCII, capitals, digits, white space, the rest each for itself.
_KIND = np.arange(256, dtype=np.uint8)
_KIND[97:123] = 97
_KIND[128:] = 97
_KIND[65:91] = 65
_KIND[48:58] = 48
_KIND[[9, 11, 12, 13]] = 32
_GAP = np.zeros(256, bool)
_GAP[[10, 32]] = True


def _counts(column: pa.Array) -> np.ndarray:
    """How often each term stands in each text: a row of TERMS for each.

    The first KIND terms are the shapes of words (kinds of characters, runs of one kind taken as
    one), pairs of adjoining shapes, and shapes of words that repeat the word before them: how a
    text is written. The others are its words, with A-Z in lower case: what it is about.
    """
    words, bounds = word_hashes(column)
    data, at = raw(column)
    shapes = shape_hashes(_KIND[data], at, _GAP)
    text = np.repeat(np.arange(len(column)), np.diff(bounds))
    pair = text[1:] == text[:-1]
    again = pair & (words[1:] == words[:-1])
    written = np.concatenate([shapes, mix(shapes[1:] * np.uint64(3) + shapes[:-1])[pair], mix(shapes[1:][again] + np.uint64(7))])
    place = lambda h: (h % np.uint64(KIND)).astype(np.int64)
    terms = np.concatenate([place(written), place(mix(words + np.uint64(11))) + KIND])
    rows = np.concatenate([text, text[1:][pair], text[1:][again], text])
    flat = rows * TERMS + terms
    return np.bincount(flat, minlength=len(column) * TERMS).reshape(len(column), TERMS)


def _blocks(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(0, b.num_rows, ROWS):
        yield b.slice(i, ROWS)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(TERMS, np.int64), 0
    for b in batches:
        for x in _blocks(b):
            df += (_counts(x.column("text")) > 0).sum(axis=0)
            n += x.num_rows
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(np.flatnonzero(df), -1)), pa.array(np.append(df[df > 0], n))], ["term", "df"]
    )


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x in _blocks(b):
            c = _counts(x.column("text"))
            at = [np.flatnonzero(r) for r in c]
            yield pa.RecordBatch.from_arrays(
                [
                    x.column("doc_id"),
                    x.column("label"),
                    x.column("pick"),
                    pa.array([i.tolist() for i in at], pa.list_(pa.int32())),
                    pa.array([r[i].tolist() for r, i in zip(c, at, strict=True)], pa.list_(pa.int32())),
                ],
                ["doc_id", "label", "pick", "terms", "counts"],
            )


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length 1: shapes and words each brought to one length, words weighing LEXICAL."""
    x = np.log1p(counts.astype(np.float32)) * idf
    x[:, :KIND] = _unit(x[:, :KIND])
    x[:, KIND:] = _unit(x[:, KIND:]) * np.float32(LEXICAL)
    return _unit(x)


class _Vectors:
    """Weighted vectors of the sample's rows, held by their terms alone; ROWS of them at a time are spread out."""

    def __init__(self, rows: pa.Table, idf: np.ndarray):
        self.n = rows.num_rows
        terms, counts = (rows.column(c).combine_chunks() for c in ("terms", "counts"))
        self.at = np.append(0, np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
        self.terms = terms.flatten().to_numpy()
        self.values = counts.flatten().to_numpy().astype(np.float32)
        for i, dense in self._spread():
            lo, hi = self.at[i], self.at[i + len(dense)]
            self.values[lo:hi] = _weighted(dense, idf)[self._rows(i, len(dense)), self.terms[lo:hi]]

    def _rows(self, i: int, n: int) -> np.ndarray:
        return np.repeat(np.arange(n), np.diff(self.at[i : i + n + 1]))

    def _spread(self) -> Iterator[tuple[int, np.ndarray]]:
        for i in range(0, self.n, ROWS):
            n = min(ROWS, self.n - i)
            dense = np.zeros((n, TERMS), np.float32)
            lo, hi = self.at[i], self.at[i + n]
            dense[self._rows(i, n), self.terms[lo:hi]] = self.values[lo:hi]
            yield i, dense

    def times(self, q: np.ndarray) -> np.ndarray:
        """The rows' products with the columns of ``q``."""
        return np.concatenate([np.zeros((0, q.shape[1]), np.float32), *(x @ q for _, x in self._spread())])

    def gram(self, q: np.ndarray) -> np.ndarray:
        """The rows' Gram matrix over terms, times ``q``."""
        out = np.zeros(q.shape, np.float32)
        for _, x in self._spread():
            out += x.T @ (x @ q)
        return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rank: int = RANK) -> dict:
    """Term weights over all of ``docs``, and labelled latent vectors of a bounded sample.

    ``labels`` (doc_id, label 0 or 1) names the rows to learn from; the ``sample`` of them with the
    smallest hash of doc_id are used; of several texts under one id the one with the smallest hash.
    The result is at most ``sample`` times ``rank`` numbers
    besides the ``TERMS`` times ``rank`` basis, so it can be broadcast.
    """
    total = docs.select("text").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    got = {r.term: r.df for r in total.collect()}
    n = got.pop(-1, 0)
    df = np.zeros(TERMS)
    df[list(got)] = list(got.values())
    idf = np.log((1 + n) / (1 + df)).astype(np.float32)
    one = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .withColumn("pick", F.xxhash64("text"))
        .mapInArrow(_sparse, "doc_id long, label int, pick long, terms array<int>, counts array<int>")
        .groupBy("doc_id").agg(F.min(F.struct("pick", "label", "terms", "counts")).alias("one"))
        .select("doc_id", "one.label", "one.terms", "one.counts")
        .toArrow()
        .sort_by("doc_id")
    )
    y = rows.column("label").to_numpy().astype(np.float32)
    x = _Vectors(rows, idf)
    k = min(rank, x.n, TERMS)
    # the basis from a randomised range of the sample's rows
    rng = np.random.default_rng(7)
    q = np.linalg.qr(x.gram(rng.standard_normal((TERMS, min(TERMS, k + 16)), dtype=np.float32)))[0] if k else None
    for _ in range(3 if k else 0):
        q = np.linalg.qr(x.gram(q))[0]
    if k:
        z = x.times(q)
        u, s, _ = np.linalg.svd(z.T @ z)
        basis = (q @ u[:, :k]).astype(np.float32)
    else:
        basis = np.zeros((TERMS, 1), np.float32)
    return {"idf": idf, "basis": basis, "vectors": _unit(x.times(basis)), "labels": y}


def _score(model, neighbours: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        vectors, labels = m["vectors"], m["labels"]
        prior = float(labels.mean()) if len(labels) else 0.5
        k = min(neighbours, len(labels))
        for b in batches:
            out = np.zeros(b.num_rows)
            for i in range(0, b.num_rows, ROWS):
                z = _unit(_weighted(_counts(b.column("text").slice(i, ROWS)), m["idf"]) @ m["basis"])
                if not k:
                    out[i : i + ROWS] = prior
                    continue
                cos = z @ vectors.T
                near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
                w = np.maximum(np.take_along_axis(cos, near, 1), 0).astype(float) ** 4
                total = w.sum(axis=1)
                out[i : i + ROWS] = np.where(total > 0, (w * labels[near]).sum(axis=1) / np.maximum(total, 1e-12), prior)
            keep = [i for i, c in enumerate(b.schema.names) if c != "text" or m["texts"]]
            yield pa.RecordBatch.from_arrays(
                [*(b.columns[i] for i in keep), pa.array(np.clip(out, 0, 1))], [*(b.schema.names[i] for i in keep), name]
            )

    return run


def score_quality(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, neighbours: int = NEIGHBOURS, keep_text: bool = False,
    name: str = "score",
) -> DataFrame:
    """Every row of ``docs`` with a score (column ``name``): how likely label 1 is, from 0 to 1.

    Each text is projected on the latent space; exact cosines with all labelled vectors, in blocks
    of rows, name its nearest neighbours, whose labels vote with the fourth power of their cosine.
    A text without words (null, empty) and one like no neighbour gets the share of label 1 in the
    sample; without labels every score is 0.5. Only the text goes into a score; other columns of
    ``docs`` stay as they are (``docs`` mustn't have one of that name), ``text`` itself with
    ``keep_text``.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    model = fit(docs, labels, sample) | {"texts": keep_text}
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text" or keep_text)
    return docs.mapInArrow(_score(spark.sparkContext.broadcast(model), neighbours, name), f"{schema}, `{name}` double")


def training_labels(labels: DataFrame) -> DataFrame:
    """Rows to learn from: those whose crc32(doc_id as text) mod 3 is not 1."""
    return labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1).select(
        "doc_id", F.col("quality").alias("label")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that score under 0.5; all columns stay."""
    return score_quality(docs, training_labels(labels), keep_text=True, name="__helix_score").where("__helix_score >= 0.5").drop("__helix_score")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_quality(docs, training_labels(table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
