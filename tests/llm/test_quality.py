import zlib
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa

from helixframe.llm import quality
from helixframe.llm.texthash import mix, word_hashes

from .conftest import prose


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = quality.op6_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good = [p for p, y in held if y == 1]
    assert sum(p == y for p, y in held) / len(held) > 0.95 and sum(good) / len(good) > 0.98


def test_only_the_text_counts(spark):
    texts = [prose(k, 50) + "." for k in range(20)] + [" | ".join(prose(k, 50).split()) for k in range(20)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 20)) for k in range(40)], "doc_id long, label int")
    first = {r.doc_id: r.score for r in quality.score_quality(docs, labels).collect()}
    assert first[3] > 0.5 > first[30]
    moved = docs.selectExpr("doc_id + 1000 AS doc_id", "text").unionByName(docs)
    again = {r.doc_id: r.score for r in quality.score_quality(moved, labels).collect()}
    assert all(abs(again[k] - again[k + 1000]) < 1e-6 for k in range(40))


def test_edges(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (7, 0), (None, 1), (5, None), (1, 1)], "doc_id long, label int")
    out = quality.score_quality(edge_docs, labels, name="new", keep_text=True)
    assert out.columns == [*edge_docs.columns, "new"] and out.count() == len(edge_rows)
    assert quality.score_quality(no_docs, labels).count() == 0
    none = quality.score_quality(edge_docs.select("doc_id", "text"), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.keep_good(no_docs, labels.withColumnRenamed("label", "quality")).columns == no_docs.columns


def test_scores_against_plain_loops(spark, sf):
    """The same vote, text by text and neighbour by neighbour, with a full SVD in place of the randomised one."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = quality.training_labels(spark.read.parquet(f"{sf}/labels.parquet"))
    got = {r.doc_id: r.score for r in quality.score_quality(docs, labels).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    wanted = {r.doc_id: r.label for r in labels.collect() if r.doc_id in texts and r.label is not None}
    kind = lambda b: 97 if 97 <= b < 123 or b > 127 else 65 if 65 <= b < 91 else 48 if 48 <= b < 58 else b

    def terms(text):
        words = [w for w in bytes(32 if b in b"\t\n\x0b\x0c\r" else b for b in text.encode()).split(b" ") if w]
        shapes = [bytes(k for i, k in enumerate(map(kind, w)) if not i or k != kind(w[i - 1])) for w in words]
        lower = [w.lower() for w in words]
        out = Counter(("shape", s) for s in shapes) + Counter(("pair", a, b) for a, b in zip(shapes, shapes[1:]))
        out += Counter(("again", s) for s, a, b in zip(shapes[1:], lower, lower[1:]) if a == b)
        return out, Counter(lower)

    @cache
    def hashed(w):
        return word_hashes(pa.array([w]), np.zeros(256, bool), np.arange(256, dtype=np.uint8))[0][0]

    @cache
    def place(t):
        if t[0] == "pair":
            return int(mix(np.array([hashed(t[2].decode()) * np.uint64(3) + hashed(t[1].decode())]))[0] % quality.KIND)
        h = hashed(t[1].decode())
        return int((mix(np.array([h + np.uint64(7)]))[0] if t[0] == "again" else h) % quality.KIND)

    rows = {}
    with np.errstate(over="ignore"):
        for i, text in texts.items():
            row = np.zeros(quality.TERMS)
            written, words = terms(text)
            for t, n in written.items():
                row[place(t)] += n
            for w, n in words.items():
                row[quality.KIND + int(mix(np.array([hashed(w.decode()) + np.uint64(11)]))[0] % quality.KIND)] += n
            rows[i] = row
    idf = np.log((1 + len(rows)) / (1 + sum(r > 0 for r in rows.values())))
    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    vector = {}
    for i, r in rows.items():
        v = np.log1p(r) * idf
        vector[i] = unit(np.concatenate([unit(v[: quality.KIND]), quality.LEXICAL * unit(v[quality.KIND :])]))
    sample = np.array([vector[i] for i in wanted])
    basis = np.linalg.svd(sample, full_matrices=False)[2][: quality.RANK].T
    near = [(unit(vector[i] @ basis), y) for i, y in wanted.items()]
    off = 0
    for i, v in vector.items():
        z = unit(v @ basis)
        best = sorted(((max(float(z @ b), 0) ** 4, y) for b, y in near), reverse=True)[: quality.NEIGHBOURS]
        total = sum(w for w, _ in best)
        score = sum(w * y for w, y in best) / total if total else sum(wanted.values()) / len(wanted)
        off += abs(score - got[i]) > 0.02
        assert abs(score - got[i]) < 0.2
    assert off <= len(got) // 50


def test_texts_that_share_an_id_fit_the_same_way(spark):
    rows = [(k, prose(k, 30) + ".") for k in range(12)] + [(k, " | ".join(prose(k + 50, 30).split())) for k in range(12)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id long, label int")
    runs = []
    for turn in (rows, rows[::-1]):
        out = quality.score_quality(spark.createDataFrame(turn, "doc_id long, text string").repartition(3), labels, keep_text=True)
        runs.append({(r.doc_id, r.text): r.score for r in out.collect()})
    assert all(abs(runs[0][k] - runs[1][k]) < 1e-4 for k in runs[0])
