"""Queries against the same results worked out in SQL by another engine."""

import duckdb
import pytest

from helixframe.plans import registry

SF = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "nation", "region", "supplier", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(v[i] for i in order) for v in values), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.execute(SQL[name])
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows([c[0] for c in want.description], want.fetchall())


def shared_ids(folder):
    """Tables in which reads of all kinds share their read_id with one of another line number."""
    con = duckdb.connect()
    for t in ("nation", "region", "supplier", "part"):
        con.execute(f"COPY (SELECT * FROM read_parquet('{SF}/{t}.parquet')) TO '{folder}/{t}.parquet' (FORMAT parquet)")
    # read_id counts 1000003 for a line and 101 for a part: one line more is 9901 parts and 2 suppliers less
    con.execute(
        "COPY (SELECT CAST(o AS BIGINT) AS l_orderkey, CAST(n + k AS INTEGER) AS l_linenumber, CAST(9901 * (1 - k) + o AS BIGINT) AS l_partkey,"
        " CAST(o % 25 + 2 * (1 - k) AS BIGINT) AS l_suppkey FROM range(75) AS a(o), range(1, 7) AS b(n), range(2) AS c(k)"
        f" WHERE o % 6 = n - 1) TO '{folder}/lineitem.parquet' (FORMAT parquet)"
    )
    for t in ("lineitem", "nation", "region", "supplier", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["demux_best_pattern", "demux_failed"])
def test_same_rows_where_reads_share_an_id(spark, tmp_path, name):
    con = shared_ids(tmp_path)
    assert con.execute(f"SELECT count(*), count(DISTINCT read_id) FROM ({SQL['scan_reads']}) AS r").fetchone() == (150, 75)
    got = registry.QUERIES[name](spark, str(tmp_path))
    want = con.execute(SQL[name])
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows([c[0] for c in want.description], want.fetchall())


def test_combined_rows_where_reads_share_an_id(spark, tmp_path):
    """The SQL leaves open which of an id's equally good reads it keeps; the query keeps the least barcodes."""
    con = shared_ids(tmp_path)
    got = registry.demux_combined(spark, str(tmp_path))
    candidates = {}
    for r in con.execute(SQL["demux_combined"].replace("row_number() OVER", "rank() OVER")).fetchall():
        candidates.setdefault(r[0], []).append(r)
    assert {1, 2} == {len(c) for c in candidates.values()}
    assert sorted(tuple(r) for r in got.collect()) == sorted(min(c) for c in candidates.values())
    assert len(con.execute(SQL["demux_combined"]).fetchall()) == got.count()


def test_lists_of_mixed_lengths_against_a_plain_loop(spark):
    from helixframe.operators.matching import MatchOptions, PatternMatcher
    from helixframe.plans import derived
    from helixframe.plans.pattern import Element, Kind, Pattern

    mixed = tuple(b[: 6 + i % 3] for i, b in enumerate(registry.FIRST))
    one = PatternMatcher(Pattern("M", (Element(Kind.LIST, "M.txt", 2, 0, mixed),)), MatchOptions(), "single")
    want = []
    for r in derived.reads(spark, SF).collect():
        m = one.match(r.seq, "")
        if m.ok:
            want.append((r.read_id, m.hits[0].barcode, m.score))
    assert sorted(tuple(r) for r in registry.variable_length_match(spark, SF).collect()) == sorted(want)


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
