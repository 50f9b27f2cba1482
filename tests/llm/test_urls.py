import datetime

from helixframe.llm import urls

D = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)


def test_intervals_end_with_the_next_entry(spark):
    e = spark.createDataFrame(
        [("A.com", "s", "block", D(5)), ("a.com", "s", "remove", D(9)), ("a.com", "s", "block", D(5)), (None, "s", "block", D(1)), ("b.com", None, "allow", None)],
        "pattern string, category string, action string, day date",
    )
    assert [tuple(r) for r in urls.intervals(e).collect()] == [("a.com", "s", "block", D(5), D(9))]


def test_captures_meet_entries_active_when_fetched(spark):
    entries = spark.createDataFrame(
        [
            ("example.com", "spam", "block", D(10)), ("example.com", "spam", "remove", D(20)),
            ("www.example.com/en/a", "ok", "allow", D(0)), ("other.org", "bad", "block", D(0)), ("other.org", "good", "allow", D(0)),
        ],
        "pattern string, category string, action string, day date",
    )
    captures = spark.createDataFrame(
        [
            (1, "https://www.example.com/x?q=1", D(9)), (2, "https://user@WWW.example.com:80/x", D(10)), (3, "http://www.example.com/en/a/b#c", D(12)),
            (4, "http://example.com", D(20)), (5, None, D(1)), (6, "", D(1)), (7, "other.org/", None), (8, "http://other.org", D(3)), (8, "http://other.org", D(3)),
        ],
        "capture_id long, url string, fetched date",
    )
    got = {r.capture_id: (r.n_active, r.action, r.blocked) for r in urls.filter_urls(captures, entries).collect()}
    assert got[1] == (0, None, False) and got[2] == (1, "block", True) and got[3] == (2, "allow", False)
    assert got[4] == (0, None, False) and got[5] == got[6] == got[7] == (0, None, False)
    assert got[8][1:] == ("allow", False)
    assert urls.filter_urls(captures.limit(0), entries).count() == 0
    assert urls.filter_urls(captures, entries.limit(0)).where("blocked").count() == 0


def test_query_covers_every_page(spark, sf):
    assert urls.op2_url_filters(spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()


def test_deep_paths_and_capitals_in_paths(spark):
    entries = spark.createDataFrame(
        [("Host.com/a/b/c/d", "s", "block", D(0)), ("host.com/Wiki/Page", "s", "block", D(0)), ("x.org/" + "/".join("abcdefgh"), "s", "block", D(0))],
        "pattern string, category string, action string, day date",
    )
    urls_of = {
        1: ("http://host.com/a/b/c/d", 1), 2: ("http://HOST.com/a/b/c/d/e?q", 1), 3: ("http://host.com/a/b/c", 0), 4: ("http://host.com/a/b/c/dd", 0),
        5: ("http://host.com/Wiki/Page/x", 1), 6: ("http://host.com/wiki/page", 0), 7: ("http://x.org/a/b/c/d/e/f/g/h/i", 1), 8: ("http://x.org/a/b/c/d/e/f/g", 0),
    }
    captures = spark.createDataFrame([(i, u, D(5)) for i, (u, _) in urls_of.items()], "capture_id long, url string, fetched date")
    got = {r.capture_id: r.n_active for r in urls.filter_urls(captures, entries).collect()}
    assert got == {i: n for i, (_, n) in urls_of.items()}
    hosts = spark.createDataFrame([("host.com", "s", "block", D(0))], entries.schema)
    assert {r.capture_id for r in urls.filter_urls(captures, hosts).where("blocked").collect()} == {1, 2, 3, 4, 5, 6}


def test_every_capture_has_a_row(spark):
    rows = [(1, "http://a.com/x", "2024-05-01"), (1, "http://a.com/y/z", "2024-05-01"), (None, "http://a.com/y/z", "2024-05-01"), (None, "http://a.com", "2024-05-01")]
    captures = spark.createDataFrame(rows, "capture_id long, url string, fetched string")
    entries = spark.createDataFrame([("a.com/y/z", None, "block", "2024-01-01")], "pattern string, category string, action string, day string")
    got = sorted((str(r.capture_id), r.blocked) for r in urls.filter_urls(captures, entries).collect())
    assert got == [("1", False), ("1", True), ("None", False), ("None", True)]
