"""Counting against known results."""

import random

import pytest

from helixframe.operators import count as c

# fixed values: inputs and results that any implementation must agree on
HEADER = ["BC1.txt", "CTTG", "15X", "BC2.txt", "GTTT", "BC3.txt"]
BC1 = "ATCACGTT,CGATGTTT,TTAGGCAT,TGACCACT,ACAGTGGT,GCCAATGT,CAGATCTG,ACTTGATG,GATCAGCG".split(",")
BC2 = "GTATCGTCGT,GTGTATGCGT,TGCTCGTAGT".split(",")
BC3 = "AACGTGAT,AAACATCG,ACACAGAA".split(",")
READS = [("CAGATCTG", "CGAGTGCTATCTCTCGA", "GTATCGTCGT")] * 11 + [
    ("CAGATCTG", "CGAGTGCTATCTCTCGA", "GTGTATGCGT"),
    ("CAGATCTG", "CGAGTGCTATCTCTGTA", "GTATCGTCGT"),
    ("CAGATCTG", "CGAGTGCTATCTCTGTA", "GTGTATGCGT"),
    ("GATCAGCG", "TGACGCTGTATACTGG", "GTGTATGCGT"),
]
NEAR = ["CGAGTGCTATCTCTCGA", *["CGTGCTATCTCTCGA"] * 3, "CTGCTTCTCTCGA", "CGTGCTACTCTCGA", "CGTGCTGCCTCTCGA"]


def table(spark, rows):
    return spark.createDataFrame(
        [(i, a, "CTTG", u, b, "GTTT", "ACACAGAA") for i, (a, u, b) in enumerate(rows)],
        "row_id long, c0 string, c1 string, c2 string, c3 string, c4 string, c5 string",
    )


def dictionaries(**more):
    return c.Dictionaries({0: BC1, 3: BC2, 5: BC3}, ["AB1", "AB2", "AB3"], [["T1", "T2", "T12"]], **more)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def config(**more):
    return c.CountConfig(**({"feature": 3, "cells": [0, 5], "umis": [2], "annotations": [5], "abundance": 0.0} | more))


def test_purity_and_names(spark):
    got = c.count(table(spark, READS), HEADER, config(purity=0.9), dictionaries())
    assert got.counts.columns == ["FEATURE_ID", "SC_ID", "FEATURE_COUNT", "ANNOTATION_BC:BC3_COL:5"]
    assert rows(got.counts) == [("AB1", "6.2", 1, "T12"), ("AB2", "8.2", 1, "T12")]
    assert rows(got.umis) == [("CGAGTGCTATCTCTCGA", "AB1", "6.2", "T12", 11), ("TGACGCTGTATACTGG", "AB2", "8.2", "T12", 1)]
    assert rows(got.log) == [(15, 3, 0)]
    assert rows(got.histogram) == [(1, "AB2", 1), (11, "AB1", 1)]


@pytest.mark.parametrize(
    ("edits", "want"),
    [
        (1, [("CGAGTGCTATCTCTCGA", 1), ("CGTGCTATCTCTCGA", 4), ("CGTGCTGCCTCTCGA", 1), ("CTGCTTCTCTCGA", 1)]),
        (2, [("CGTGCTATCTCTCGA", 7)]),
    ],
)
def test_near_umis_join_the_most_read(spark, edits, want):
    got = c.count(table(spark, [("CAGATCTG", u, "GTATCGTCGT") for u in NEAR]), HEADER, config(umi_mismatches=edits), dictionaries())
    assert sorted((r.UMI, r.UMI_COUNT) for r in got.umis.collect()) == want


def test_abundance_keeps_umis_that_are_read_as_often(spark):
    reads = [("CAGATCTG", u, "GTATCGTCGT") for u in ["AAAA"] * 10 + ["AAAT"] * 3 + ["AATA"]]
    got = c.count(table(spark, reads), HEADER, config(abundance=0.2), dictionaries())
    assert sorted((r.UMI, r.UMI_COUNT) for r in got.umis.collect()) == [("AAAA", 11), ("AAAT", 3)]


def test_without_umis_all_reads_count(spark):
    got = c.count(table(spark, READS), HEADER, config(umis=[1]), dictionaries())
    assert rows(got.counts) == [("AB1", "6.2", 12, "T12"), ("AB2", "6.2", 2, "T12"), ("AB2", "8.2", 1, "T12")]
    assert got.umis.count() == 0


def test_sharing_and_cells_as_strings(spark):
    shared = spark.createDataFrame([(0, "CAGATCTG", "GATCAGCG")], "position int, retained string, replaced string")
    got = c.count(table(spark, READS), HEADER, config(umi_mismatches=0, cell_as_string=True), dictionaries(sharing=shared))
    assert {r.SC_ID for r in got.counts.collect()} == {"CAGATCTGACACAGAA"}


def test_unknown_barcodes_fail(spark):
    with pytest.raises(Exception, match="unknown cell barcode: NNNN"):
        c.count(table(spark, [("NNNN", "ACG", BC2[0])]), HEADER, config(), dictionaries()).counts.collect()


def test_roles_are_checked():
    with pytest.raises(ValueError, match="no column 9"):
        c.resolve_roles(HEADER, config(cells=[9]))
    with pytest.raises(ValueError, match="no whitelist"):
        c.resolve_roles(HEADER, config(cells=[1]))
    assert c.resolve_roles(HEADER, config(umis=None)).umis == (2,)


def test_ragged_lines_are_dropped(spark):
    lines = spark.createDataFrame([(0, "a\tb\t"), (1, "a\t\tb\r"), (2, "a"), (3, "a\tb\tc")], "row_id long, value string")
    assert rows(c.clean_rows(lines, 2)) == [(0, "a", "b"), (1, "a", "b")]


@pytest.mark.parametrize("hamming", [False, True])
@pytest.mark.parametrize("abundance", [0.0, 0.5])
@pytest.mark.parametrize("edits", [1, 2])
def test_the_indexed_fold_is_the_plain_one(hamming, abundance, edits):
    rng = random.Random(3)
    umis = {"".join(rng.choices("ACGT", k=5)): rng.randint(1, 9) for _ in range(150)}
    cfg = config(hamming=hamming, abundance=abundance, umi_mismatches=edits)
    plain = []
    for n, u in sorted(((n, u) for u, n in umis.items()), reverse=True):
        for r in plain:
            if c.within_distance(r[0], u, edits, hamming) and (abundance <= 0 or n < abundance * r[1]):
                r[2] += n
                r[3] += 1
                break
        else:
            plain.append([u, n, n, 1])
    assert c.fold(list(umis.items()), cfg) == plain
