import re

import pytest

from helixframe.llm import licenses

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEXTS = [
    "Licensed under CC BY-NC 4.0.", "ALL RIGHTS RESERVED. all rights reserved", "cc by cc by CC-BY", "GNU General\nPublic License", "Released under the MIT License.",
    "This work is licensed under the GNU General Public License, version 3.", "rights reserved all", "Licensed under the Apache License", "KKcc by İ", "", None, "....", "accord by",
    "Licensed under\nthe Apache License, Version 2.0.", "licensed under the apache license , version 2.0 and much more besides",
]


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def want(t):
    ws = words(t)
    at, labels = [], set()
    for p, label in PHRASES.items():
        q = p.split()
        here = [k for k in range(len(ws) - len(q) + 1) if ws[k : k + len(q)] == q]
        at += here
        labels |= {label} if here else set()
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def templates_of(t):
    out = set()
    for line in re.split("[\n\r]+", t or ""):
        have = set(words(line))
        for label, text in licenses.TEMPLATES.items():
            need = set(text.split())
            if len(have & need) >= licenses.CONTAINMENT * len(need):
                out.add(label)
    return out


def check(rows, docs):
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, t in docs:
        for r in by[i]:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want(t), t
            assert set(filter(None, r.labels.split(","))) == set(filter(None, r.base_labels.split(","))) | templates_of(t), t
            assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_phrases_and_templates(spark):
    docs = list(enumerate(TEXTS))
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, row string")
    check(licenses.scan_licenses(df).collect(), docs)


def test_query(spark, sf, sf_docs):
    check(licenses.op9_licenses(spark, sf).collect(), sf_docs)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    rows = licenses.scan_licenses(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    check(rows, [(i, t) for i, t in edge_rows if i is not None])
    assert licenses.scan_licenses(no_docs).count() == 0


BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"
MPL = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL"
WRAPPED = {
    1: (BSD, "bsd"), 2: (MPL, "mpl-2.0"),
    3: ("/*\n * Copyright\n *\n" + "".join(f" * {x}\n" for x in BSD.split("\n")) + " */\n\nint x;", "bsd"),
    4: ("".join(f"// {x}\r\n" for x in MPL.split("\n")), "mpl-2.0"),
    5: ("one line\n\n" + BSD.replace(" ", "\n") + "\nand more", "bsd"),  # a word a line
    6: ("\n\nLicensed under\n\nthe Apache License,\n# Version 2.0.", "apache-2.0"),
    7: ("x " * 200 + "licensed\nunder CC BY\n4.0 " + "y " * 200, "cc-by,cc-by-4.0,cc-by-nc-4.0,cc-by-sa-4.0"),  # as on one line
    8: ("licensed under\n" + "x " * 100 + "\nthe apache license\n" + "x " * 100 + "\nversion 2.0", ""),
    13: ("Licensed under the Apache License,\nVersion 2.0. Es war mit", "apache-2.0"),  # no mit license
    9: ("", ""), 10: (None, ""), 11: ("\n \r\n", ""), 12: (BSD.replace("\n", " "), "bsd"),
}


def test_notices_that_wrap(spark, tmp_path):
    spark.createDataFrame([(i, t) for i, (t, _) in WRAPPED.items()], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in licenses.op9_licenses(spark, str(tmp_path)).collect()}
    assert {i: r.labels for i, r in got.items()} == {i: want for i, (_, want) in WRAPPED.items()}
    assert all((r.score >= licenses.CONTAINMENT) == bool(r.labels) for r in got.values())
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").where("doc_id in (3, 12)")
    blocks = {r.doc_id: {m.block for m in r.matches} for r in licenses.scan_licenses(docs, wrapped=True).collect()}
    assert blocks[12] == {0} and blocks[3] and max(blocks[3]) < 0


def test_tokens_with_marks_of_patterns(spark):
    df = spark.createDataFrame([(1, "plain licence words here"), (2, "cc licence words")], "doc_id long, text string")
    rows = licenses.scan_licenses(df, {"odd": "(c plain licence words here", "plus": "c++ words"}).collect()
    assert {r.doc_id: r.labels for r in rows} == {1: "odd", 2: ""}


def test_templates_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(licenses, "MAX_PREFIX_BYTES", 1000)
    with pytest.raises(ValueError, match="1000 bytes"):
        licenses.template_tokens(spark, {"long": " ".join(f"word{i}" for i in range(100))}, licenses.CONTAINMENT)
    assert licenses.template_tokens(spark, {"mit": licenses.TEMPLATES["mit"]}, licenses.CONTAINMENT).count() == 5
