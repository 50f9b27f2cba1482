import hashlib
import re

import pytest

from helixframe.llm import exact_dedup as x


def plain(t):
    return re.sub(r"[\x20\x09-\x0D]+", "", t or "")


def want(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(plain(t), []).append((-len(t or ""), i is None, i or 0, k))
    out = []
    for k, (i, t) in enumerate(rows):
        g = sorted(groups[plain(t)])
        keep = rows[g[0][3]][0]
        out.append((i, keep, len(g), hashlib.sha256(plain(t).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


def test_marks(edge_docs, edge_rows, no_docs):
    marks = x.mark_copies(edge_docs)
    assert got(marks) == want(edge_rows)
    assert marks.where("kept").count() == len({plain(t) for _, t in edge_rows})
    assert x.mark_copies(no_docs).count() == 0


def test_query(spark, sf, sf_docs):
    assert got(x.op8_exact_dedup(spark, sf)) == want(sf_docs)


def test_short_blocks_name_as_long_ones_do(spark):
    texts = ["abcabcabc", "abcabcabd", "abcabcabc", "", "abc", "abcabc", "a" * 40, "a" * 41, "😀" * 9, "😀" * 9]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    named = {r.i: (r.levels, r.name) for r in x.identities(docs, block=3).collect()}
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (named[i] == named[j]) == (a == b)


def test_blocks_that_share_a_hash_are_told_apart(spark, monkeypatch):
    real = x.F.xxhash64
    monkeypatch.setattr(x.F, "xxhash64", lambda c: real(x.F.length(c)))  # every block of one length collides
    docs = spark.createDataFrame([(0, "abcd"), (1, "abce"), (2, "abcd"), (3, "xyz")], "i long, text string")
    named = {r.i: (r.levels, r.name) for r in x.identities(docs, block=2).collect()}
    assert named[0] == named[2] and len(set(named.values())) == 3


def test_dropping_copies_keeps_columns_and_one_row_each(edge_docs, edge_rows):
    kept = x.drop_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(plain(r.text) for r in kept.collect()) == sorted({plain(t) for _, t in edge_rows})


@pytest.mark.parametrize("n", [1, 40])
def test_repeated_rows_leave_one(spark, n):
    docs = spark.createDataFrame([(1, "same text")] * n + [(2, "same  text")], "doc_id long, text string")
    assert [r.doc_id for r in x.drop_copies(docs).collect()] == [2]
