import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from helixframe.llm import packing


def check(rows, docs, capacity=2048):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = []
    for i, t in docs:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)] if first < len(ids) else [0, len(ids)]
        want += [(str(i), k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r.length for r in rows) // capacity)


def test_query(spark, sf, sf_docs):
    used, least = check(packing.op4_packing(spark, sf).collect(), sf_docs)
    assert used <= least * 1.05 + 2


def test_edges(spark, edge_docs, edge_rows, no_docs):
    check(packing.pack_with_public_tokenizer(edge_docs).collect(), edge_rows)
    assert packing.pack_with_public_tokenizer(no_docs).count() == 0


def fits(packed, histogram, capacity):
    seen = {}
    for lengths, n in packed:
        assert sum(lengths) <= capacity and n > 0
        for x in lengths:
            seen[x] = seen.get(x, 0) + n
    assert seen == {k: v for k, v in histogram.items() if v}
    return sum(n for _, n in packed)


def test_plans_hold_every_length_in_few_sequences():
    rng = random.Random(1)
    for _ in range(30):
        capacity = rng.choice([10, 64, 300, 1000])
        h = {n: rng.randint(0, 50) for n in rng.sample(range(1, capacity + 1), min(capacity, rng.randint(1, 60)))}
        used = fits(packing.plan(h, capacity, rng.choice([32, 64])), h, capacity)
        least = -(-sum(k * v for k, v in h.items()) // capacity)
        first_fit: list[int] = []
        for k in sorted(h, reverse=True):
            for _ in range(h[k]):
                at = next((i for i, r in enumerate(first_fit) if r >= k), None)
                if at is None:
                    first_fit.append(capacity - k)
                else:
                    first_fit[at] -= k
        assert least <= used <= len(first_fit) * 1.03 + 8
    assert packing.plan({}, 10) == []


def test_a_plan_is_on_counts_whatever_their_size():
    h = {n: 10**9 + n for n in range(1, 2049, 7)}
    used = fits(packing.plan(h), h, 2048)
    assert used <= 1.02 * sum(k * v for k, v in h.items()) / 2048 + 100


def test_configurations_reach_the_linear_bound():
    chosen = packing.configurations(np.array([6, 4]), np.array([1000, 1000]), 10)
    assert sum(m for _, m in chosen) == 1000


def test_long_runs(spark):
    """Texts that the faster library refuses, or takes as one piece."""
    rows = [(1, "a" + "\n" * 1_000_000), (2, " " * 1_000_000), (3, "x" * 1_000_000), (4, "\t \n" * 100_000), (5, "b")]
    check(packing.pack_with_public_tokenizer(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_sequences_at_ten_thousand_documents(spark):
    """As few as the tokens allow, give or take one in a thousand."""
    got = packing.op4_packing(spark, "/root/testdata/sf0.1")
    from pyspark.sql import functions as F

    r = got.agg(F.countDistinct("sequence_id").alias("used"), F.sum("length").alias("tokens")).first()
    assert r.used <= -(-r.tokens // 2048) * 1.001 + 1
