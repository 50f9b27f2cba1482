"""Patterns and matching against known results, and properties of both."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helixframe.functions.align import prefix_align, prefix_distances, within_distance
from helixframe.functions.seq import revcomp_text
from helixframe.operators import demux
from helixframe.operators.matching import Matcher, MatchOptions, PatternMatcher, best_match, indel_tables, substitution_table
from helixframe.plans.pattern import Element, Kind, combined, conversion_rates, parse_patterns

# fixed values: inputs and results that any implementation must agree on
FILES = {
    "test1BC1.txt": "AGAG,TCTC,ATAT",
    "test1BC2.txt": "CGACGA,CACA,TTTTTA,GTACA",
    "multi.txt": "AAAA,AACC,CCCC,CCTT,TTTT,TTGG,GGGG",
    "last1.txt": "AAA,CCC,GGG,TTT",
    "last2.txt": "ACAC,TATA,GTGT,CGCG",
}
SINGLE = """
AGATATCAGTCAACAGATAAGCGACACAAAGATCAT -
AGAGATCAGTCAACAGATAAGCGACACATTTGATCAT AGAG CACA TTT
ATATATCAGTCAACAGATAAGCGACGACGAAAAGATCAT ATAT CGACGA AAA
ATATATCAGTCGACAGACAAGCGACGACGACCCGATCAT ATAT CGACGA CCC
AGAGATCGTTAACAGATAAGCGACACAGGGGATCAT AGAG CACA GGG
AAGATCAGTCAACAGATAAGCGACACAAGTCGATCAT AGAG CACA AGT
ATATATCAGTCAACAGATAAGCGATTTTTTAGTCGATCAT ATAT TTTTTA AGT
AGAGATCAGTCAACAGATAAGCGACACATTGATCAT AGAG CACA TTG
ATATATCAGTCAACAGATAAGCGACGACGAAAGCGATCAT ATAT CGACGA AAG
ATAATCAGTCAACAGATAAGCGACGACGAAAGCGATCAT ATAT CGACGA AAG
TCTCGTCAGTCAACAGATAAGCGACGACGAAAGCGATCAT TCTC CGACGA AAG
TCTGGGTCGGTCAACAGATAAGCGACGACGAAAGCGATCAT TCTC CGACGA AAG
TCTAAAAAGTCCGTCAACAGATAAGCGACGACGTAAGCGATCAT -
TCTGGATCAGTCAACAGATAAGCGACGACGTAAGCGATCAT TCTC CGACGA AAG
AGAGATCAGTCAACAGATAAGCGACACAGGGATCAT AGAG CACA GGG
AGGGATCAGTCAACAGATAAGCGGCACATTTGATCAT AGAG CACA TTT
AGAGATCAGTCAACAGATAAGCGGCAGGTTTGATCAT -
AGGGATCAGTCAACAGATAAGCGGCACATTTTCAT AGAG CACA TTT
"""
COMPETING = """
TAAAACGTCATCGCATCAACC 0 AAAA ACGTC ACT CGCAT AACC
ATTTACGTCACTGGCATCAAAA 1 TTTT ACGTC ACTG GCATC AAAA
CGGGACGTCACTGTGCATCTTTT 2 GGGG ACGTC ACTGT GCATC TTTT
AAAAACGTCACTGGCATCAACC 0 AAAA ACGTC ACT GGCAT AACC
TTTTACGTCACTGCATCCCTT 1 TTTT ACGTC ACTG CATCC CCTT
GGGGACGTCACTGCATCGGAAA 2 GGGG ACGTC ACTGT ATCGG AAAA
"""
dna = st.text("ACGT", max_size=12)


def patterns(text, edits):
    return parse_patterns(text, edits, FILES.get)


def test_mixed_lists_and_constants_with_edits():
    (p,) = patterns("TEST1:[test1BC1.txt][ATCAGTCAACAGATAAGCGA][test1BC2.txt][3X][GATCAT]", "1,4,1,1,2")
    m = PatternMatcher(p, MatchOptions(), "single")
    for line in SINGLE.strip().split("\n"):
        read, *want = line.split()
        got = m.match(read, "")
        assert got.ok == (want != ["-"]), read
        if got.ok:
            b = [h.barcode for h in got.hits]
            assert [b[0], b[2], b[3]] == want and b[1] == "ATCAGTCAACAGATAAGCGA" and b[4] == "GATCAT"


def test_the_pattern_with_fewest_edits_wins():
    ps = patterns(
        "P1:[AAAA][5X][ACT][5X][multi.txt]\nP2:[TTTT][5X][ACTG][5X][multi.txt]\nP3:[GGGG][5X][ACTGT][5X][multi.txt]",
        "3,0,1,0,2\n3,0,2,0,2\n3,0,3,0,2",
    )
    ms = [PatternMatcher(p, MatchOptions(), "single") for p in ps]
    for line in COMPETING.strip().split("\n"):
        read, at, *want = line.split()
        i, m = best_match(ms, read, "", "", "")
        assert i == int(at) and [h.barcode for h in m.hits] == want


def test_equal_scores_go_to_the_first_pattern():
    ps = patterns("A:[3X][ACG]\nB:[3X][ACG]", "0,0\n0,0")
    assert best_match([PatternMatcher(p, MatchOptions(), "single") for p in ps], "TTTACG", "", "", "")[0] == 0


def test_pairs_overlap_gap_and_failure():
    (p,) = patterns("P:[last1.txt][5X][GGATT][last2.txt]", "1,0,1,1")
    m = PatternMatcher(p, MatchOptions(), "paired")
    whole = "CCC" + "AACGT" + "GGATT" + "TATA"
    full = m.match(whole, "", revcomp_text(whole), "")
    assert full.ok and [h.barcode for h in full.hits] == ["CCC", "AACGT", "GGATT", "TATA"] and full.score == 0
    gap = m.match(whole[:8], "", revcomp_text("TATA"), "")
    assert gap.ok and [h.barcode for h in gap.hits] == ["CCC", "AACGT", "GGATT", "TATA"]
    assert not m.match(whole[:3], "", revcomp_text("TATA"), "").ok  # a random part can't be filled in
    assert not m.match(whole, "", revcomp_text("CCC" + "AACGT" + "GGATT" + "GTGT"), "").ok


def test_the_opposite_strand_gives_random_parts_as_read():
    (p,) = patterns("P:[last1.txt][5X][last2.txt]", "0,0,0")
    m = PatternMatcher(p, MatchOptions(), "paired")
    got = m.match("CCC", "", revcomp_text("AACGTTATA"), "")
    assert [h.barcode for h in got.hits] == ["CCC", revcomp_text("AACGT"), "TATA"]


def test_independent_reads_have_their_own_halves():
    (p,) = patterns("P:[last1.txt][5X][-][last2.txt][*]", "0,0,0,1,0")
    m = PatternMatcher(p, MatchOptions(), "independent")
    got = m.match("CCCAACGTAAA", "", "TATTGG", "")
    assert got.ok and [h.barcode for h in got.hits] == ["CCC", "AACGT", "TATA"] and got.score == 1
    with pytest.raises(ValueError, match=r"\[-\]"):
        PatternMatcher(patterns("P:[5X][ACG]", "0,0")[0], MatchOptions(), "independent")


def test_free_dna_takes_the_rest_of_its_read():
    (p,) = patterns("P:[last1.txt][DNA][-][last2.txt]", "0,0,0,0")
    got = PatternMatcher(p, MatchOptions(), "paired").match("CCCTTGACA", "ABCDEFGHI", revcomp_text("TATA"), "JJJJ")
    assert got.ok and got.dna == "TTGACA" and got.dna_quality == "DEFGHI"


def test_rules_of_equal_length_lists():
    (p,) = patterns("P:[last2.txt]", "1")
    m = PatternMatcher(p, MatchOptions(), "single")
    assert m.match("TATA", "").score == 0
    assert m.match("TACA", "").hits[0].substitutions == 1
    assert m.match("TAGTA", "").hits[0].insertions == 1
    hamming = PatternMatcher(p, MatchOptions(hamming=True), "single")
    assert not hamming.match("TAGTA", "").ok and hamming.match("TACA", "").ok
    none = PatternMatcher(patterns("P:[last2.txt]", "0")[0], MatchOptions(), "single")
    assert not none.match("TAT", "").ok  # no deletion at the read's end without allowed edits
    assert not none.match("", "").ok


def test_mixed_lengths_follow_list_order():
    FILES["mixed1"], FILES["mixed2"] = "ATC,ATCATC", "ATCATC,ATC"
    try:
        ask = lambda f: PatternMatcher(patterns(f"P:[{f}]", "1")[0], MatchOptions(), "single").match("ATCATC", "")
        assert not ask("mixed1").ok
        assert ask("mixed2").hits[0].barcode == "ATCATC"
    finally:
        del FILES["mixed1"], FILES["mixed2"]


def test_neighbourhoods():
    s = substitution_table(["AA", "AC"])
    assert s["TA"] == "AA" and s["AG"] is None
    assert substitution_table(["AA", "AA"])["TA"] is None
    inserted, deleted = indel_tables(["AC", "GT"])
    assert inserted["ACG"] == "AC" and deleted["C"] == "AC" and inserted["GTT"] == "GT"


def test_pattern_files():
    ps = patterns("A:[ACG][10x]\n\n[*]", "1,0\n0")
    assert [p.name for p in ps] == ["A", "PATTERN_1"]
    assert ps[0].columns == ["ACG", "10X"] and ps[1].elements[0].kind is Kind.STOP
    for text, edits in (("A:B:[ACG]", "1"), ("A:", "1"), ("[acg]", "0"), ("[ACG]", "1,1"), ("[ACG]", "-1"), ("A:[ACG]\nA:[ACG]", "0\n0")):
        with pytest.raises(ValueError, match="."):
            patterns(text, edits)


def test_combined_lists_are_laid_end_to_end():
    ps = patterns("A:[last1.txt][ACG]\nB:[multi.txt][ACG]", "0,0\n0,0")
    e = combined(ps).elements[0]
    assert e.name == "last1&multi.txt" and len(e.barcodes) == 11 and not e.equal_length


def test_conversion_rates():
    assert conversion_rates(["AAAA", "AAAT", "CCCC"]) == {"AAAA": 1, "AAAT": 1, "CCCC": 4}


@given(dna)
def test_reverse_complement_twice_is_the_same(s):
    assert revcomp_text(revcomp_text(s)) == s


@given(st.text("ACGT", min_size=1, max_size=9), dna)
@settings(max_examples=200, deadline=None)
def test_prefix_alignment_finds_the_least_distance(p, t):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, above = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(above[j - 1] + (x != y), above[j] + 1, row[-1] + 1))
        return row[-1]

    import numpy as np

    best = min(distance(p, t[:n]) for n in range(len(t) + 1))
    assert sum(prefix_align(p, t, 99)[1:]) == best
    codes = np.array([list(p.encode())], np.uint8)
    assert prefix_distances(codes, np.array([len(p)]), t)[0] == best
    assert within_distance(p, t, 2, False) == (distance(p, t) <= 2)


@pytest.mark.parametrize(("edits", "indels"), [(1, False), (2, True), (2, False), (3, True)])
def test_long_lists_of_equal_length_are_aligned_like_short_ones(edits, indels):
    rng = random.Random(edits)
    listed = tuple(dict.fromkeys("".join(rng.choices("ACGT", k=12)) for _ in range(2300)))
    e = Element(Kind.LIST, "long.txt", edits, 12, listed)
    pruned, whole = (Matcher(e, None, MatchOptions(precalculate_indels=indels, max_candidates=n)) for n in (2000, len(listed)))
    found = 0
    for _ in range(120):
        read = list(rng.choice(listed) + "".join(rng.choices("ACGT", k=6)))
        for _ in range(edits):
            at, kind = rng.randrange(11), rng.randrange(3)
            read[at : at + (kind < 2)] = rng.choice("ACGTN") if kind else ""
        for text in ("".join(read), "".join(read[: 12 - edits])):  # the second ends early
            window = pruned._window(text, 0)
            assert pruned.align_all(window) == whole.align_all(window)
            found += pruned.align_all(window) is not None and pruned.at(text, 0) is not None
    assert found > 50
    mixed = Element(Kind.LIST, "mixed.txt", edits, 0, (*listed, "ACGT"))
    assert Matcher(mixed, None, MatchOptions()).at(listed[0], 0) is None  # as in the reference


def test_settled_reads_and_the_matcher_agree_under_several_patterns(spark):
    """Reads with none to three edits under patterns that compete: the whole against the matcher alone."""
    ps = patterns(
        "P1:[last1.txt][3X][GGATT][last2.txt]\nP2:[last2.txt][3X][GGAT][last1.txt]\nP3:[last1.txt][3X][GGATT][last2.txt]",
        "1,0,1,1\n1,0,0,1\n0,0,0,0",
    )
    rng, reads = random.Random(4), [(0, "n", None, None), (1, "n", "", ""), (2, None, "CCC", "III")]
    lists = [e.barcodes for e in ps[0].elements if e.kind is Kind.LIST]
    for k in range(3, 1500):
        a, b = lists if rng.random() < 0.5 else lists[::-1]
        read = list(rng.choice(a) + "".join(rng.choices("ACGT", k=3)) + rng.choice(("GGATT", "GGAT")) + rng.choice(b))
        for _ in range(rng.choice((0, 0, 1, 2, 3))):
            at = rng.randrange(len(read))
            read[at] = rng.choice(("", "A", "C", "G", "T", read[at] + rng.choice("ACGT")))
        seq = "".join(read) + "".join(rng.choices("ACGT", k=rng.randrange(3)))
        reads.append((k, f"r{k}", seq, "I" * len(seq)))
    df = spark.createDataFrame(reads, "read_id long, name string, seq string, qual string").repartition(3)
    for some in (ps, ps[:1], ps[::-1], ps[1:]):
        out = demux.demultiplex(df, some)
        assert "Union" in out._jdf.queryExecution().toString()  # some are settled without the matcher
        alone = [PatternMatcher(p, MatchOptions(), "single") for p in some]
        got = {r.read_id: r for r in out.collect()}
        assert len(got) == len(reads)
        for k, _, seq, _ in reads:
            i, m = best_match(alone, seq or "", "", "", "")
            want = (i, [h.barcode for h in m.hits], m.score, [(h.insertions, h.deletions, h.substitutions) for h in m.hits]) if i >= 0 else (-1, None, None, None)
            r = got[k]
            assert (r.pattern_idx, r.barcodes, r.score, r.edits and [tuple(e) for e in r.edits]) == want, seq
            assert r.fail_fw == (m.fail_fw if i < 0 else None)
        assert {r.pattern_idx for r in got.values()} >= {-1, 0}


def test_failed_reads_as_they_came_where_ids_repeat_or_lack(spark):
    ps = patterns("P:[last1.txt][3X][-][GGATT]", "0,0,0,0")
    good = next(e for e in ps[0].elements if e.kind is Kind.LIST).barcodes[0] + "AAA"
    reads = [
        (1, "a", good, "I" * len(good), "GGATT", "JJJJJ"), (1, "a", "C", "K", "GGATT", "LLLLL"), (None, None, "G", None, None, None),
        (None, "b", good, None, "GGATT", None), (2, "c", None, None, "A", "M"),
    ]
    df = spark.createDataFrame(reads, "read_id long, name string, seq string, qual string, seq_rv string, qual_rv string")
    for mode in ("single", "independent"):
        rows = demux.demultiplex(df, ps, mode)
        assert sorted((tuple(r) for r in demux.failed(rows, df.columns).collect()), key=str) == sorted((reads[i] for i in (1, 2, 4)), key=str)
        assert [tuple(r) for r in demux.matched(rows).select(*demux.READ).distinct().collect()] == [(None,) * 4]
