import math
import random
import re

import pytest

from helixframe.llm import jaccard
from helixframe.llm.components import components

from .conftest import prose


def shingles(t):
    w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def want(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(a)] = find(b)
    out = []
    for k, (i, s) in enumerate(sets):
        ids = [j for m, (j, _) in enumerate(sets) if find(m) == find(k) and j is not None]
        out.append((i, len(s), min(ids) if s and ids else i))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edited(rng, words, n):
    w = words.copy()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return w


def variants():
    """Small sets around every boundary, and a crowd of copies that are near one another by chance."""
    rng = random.Random(9)
    rows = []
    for size in range(1, 24):
        base = [f"w{size}x{k}" for k in range(size)]
        for _ in range(3):
            rows.append(" ".join(base[: rng.randint(max(1, size - 2), size)]))
            rows.append(" ".join([*base, "tail"][: size + 1]))
    base = prose(3, 150).split()
    base = [f"{w}{k}" for k, w in enumerate(base)]
    rows += [" ".join(edited(rng, base, rng.randint(0, 5))) for _ in range(60)]
    return list(enumerate(rows))


def test_all_links_of_hard_sets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LEADERS", 2)
    monkeypatch.setattr(jaccard, "STEP", 2)
    rows = variants()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(jaccard.near_duplicates(df)) == want(rows)


@pytest.mark.parametrize("boundary", [0, 9, 16])
def test_the_boundary_changes_no_link(spark, monkeypatch, boundary):
    monkeypatch.setattr(jaccard, "choose_boundary", lambda *_: boundary)
    rows = variants()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(jaccard.near_duplicates(df)) == want(rows)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    assert got(jaccard.near_duplicates(edge_docs)) == want(edge_rows)
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_query(spark, sf, sf_docs):
    assert got(jaccard.op10_ngram_jaccard(spark, sf)) == want(sf_docs)


def test_bounds():
    for a in range(1, 60):
        for b in range(a, 80):
            o = jaccard.least_overlap(a, b)
            assert 100 * o >= 80 * (a + b - o) and 100 * (o - 1) < 80 * (a + b - o + 1)
            assert (b in jaccard.partners(a)) == (o <= a)
    assert jaccard.choose_boundary({3: 10}, 5.0) >= 3 and math.comb(5, 4) == 5
    assert jaccard.choose_boundary({}, 1.0) == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    e = spark.createDataFrame([*chain, *star, (7, 7), (200, 199), (199, 200)], "a long, b long")
    roots = {r.node: r.root for r in components(e).collect()}
    assert all(roots[i] == 0 for i in range(41)) and all(roots[i] == 100 for i in range(100, 160)) and roots[200] == 199


def test_one_of_each_class_stays(edge_docs, edge_rows):
    kept = jaccard.keep_representatives(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted({str(i) for i, _, c in want(edge_rows) if i == c})


def test_only_linked_rows_of_an_id_go(spark):
    """Rows are known by doc_id and text: one id on several texts, null ids, and a linked row beside an unlinked one."""
    text = prose(40, 80)
    rows = [
        (1, prose(41, 60)), (1, prose(42, 60)), (None, prose(43, 60)), (None, prose(44, 60)), (3, text),
        (4, text + " more"), (4, prose(45, 50)), (None, text + " other"), (5, ""), (5, None), (6, prose(46, 30)), (6, prose(46, 30)),
    ]
    kept = jaccard.keep_representatives(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [*rows[:5], rows[6], rows[8], rows[10]]
    got = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_subsets_in_blocks(monkeypatch):
    monkeypatch.setattr(jaccard, "SUBSETS", 7)
    blocks = list(jaccard._subsets(9, 4))
    assert max(map(len, blocks)) == 7 and len({tuple(r) for b in blocks for r in b.tolist()}) == math.comb(9, 4)
