"""URL filters as a temporal list join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table


def intervals(entries: DataFrame) -> DataFrame:
    """Dated list entries as validity intervals: (pattern, category, action, since, until).

    ``entries`` has pattern (a host, or a host and the start of a path), category, action ("block",
    "allow" or "remove") and day. An entry holds from its day until the next one for the same
    pattern and category; "remove" ends the one before and leaves none. Of entries on one day the
    greatest action by name counts, so repeats change nothing. Null patterns or days are dropped.
    Hosts of patterns are lower-cased, paths keep their case.
    """
    host = F.regexp_extract("pattern", "^[^/]*", 0)
    pattern = F.concat(F.lower(host), F.substr("pattern", F.length(host) + 1))
    one = (
        entries.where("pattern is not null and day is not null")
        .groupBy(pattern.alias("pattern"), F.coalesce("category", F.lit("")).alias("category"), F.col("day").cast("date").alias("day"))
        .agg(F.max("action").alias("action"))
    )
    w = Window.partitionBy("pattern", "category").orderBy("day")
    return (
        one.withColumn("until", F.lead("day").over(w))
        .where(F.col("action").isin("block", "allow"))
        .select("pattern", "category", "action", F.col("day").alias("since"), "until")
    )


def url_parts(url):
    """Lower-cased host without port, and path from its "/", without query or fragment."""
    bare = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place = F.regexp_extract(bare, r"^[^?#]*", 0)
    authority = F.regexp_extract(place, r"^[^/]*", 0)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""))
    return host, F.regexp_replace(place, r"^[^/]*", "")


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """As-of join of captures (capture_id, url, fetched) with the list entries active at fetch time.

    A capture is tried under its host, each parent domain of two labels or more, and its host with
    its leading path segments, as many as the deepest path in ``entries`` has at most (read from
    it first). Of the active entries the one with the longest
    pattern decides ("allow" beats "block" at equal length, then the smaller category). Returns
    capture_id, host, fetched, n_active, pattern, category, action and blocked; captures under no
    entry keep nulls and blocked false, as do those with a null url or fetch day. Each row of
    ``captures`` gives one row, also where ids repeat or are null; other columns are left out.

    The join is an equi-join on the pattern with the interval as a further condition; a host with
    a third of all captures is a skewed key on the capture side only, which Spark splits, and the
    rows are of fixed small width.
    """
    host, path = url_parts(F.col("url"))
    c = captures.select(F.monotonically_increasing_id().alias("row"), F.col("capture_id").cast("long").alias("capture_id"), host.alias("host"), path.alias("path"), F.col("fetched").cast("date").alias("fetched"))
    labels = F.split("host", r"\.")
    n = F.size(labels)
    domains = F.when(
        n >= 2, F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.array_join(F.slice(labels, i + 1, n), "."))
    ).otherwise(F.array("host"))
    segments = F.filter(F.split(F.regexp_replace("path", "^/", ""), "/"), lambda s: s != "")
    listed = intervals(entries)
    depth = F.size(F.split("pattern", "/")) - 1
    deepest = listed.agg(F.max(depth)).first()[0] or 0
    deep = F.least(F.size(segments), F.lit(deepest))
    prefixes = F.when(
        deep >= 1,
        F.transform(F.sequence(F.lit(1), deep), lambda i: F.concat(F.col("host"), F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/"))),
    ).otherwise(F.array().cast("array<string>"))
    keys = c.select("row", "capture_id", "host", "fetched", F.explode_outer(F.array_distinct(F.concat(domains, prefixes))).alias("pattern"))
    k, e = keys.alias("k"), listed.alias("e")
    hits = k.join(
        e,
        (F.col("k.pattern") == F.col("e.pattern"))
        & (F.col("k.fetched") >= F.col("e.since"))
        & (F.col("e.until").isNull() | (F.col("k.fetched") < F.col("e.until"))),
        "left",
    ).select("row", "capture_id", "host", "fetched", "e.pattern", "e.category", "e.action")
    order = F.struct(
        (-F.length("pattern")).alias("n"), F.col("action"), F.col("category"), F.col("pattern")
    )
    best = hits.groupBy("row", "capture_id", "host", "fetched").agg(
        F.count("pattern").alias("n_active"), F.min(F.when(F.col("pattern").isNotNull(), order)).alias("best")
    )
    return best.select(
        "capture_id", "host", "fetched", "n_active",
        "best.pattern", "best.category", "best.action",
        F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked"),
    )


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of ``pages``, as the tables hold none.

    Every domain of a host gets entries by fixed rules on the length of its name: blocked on a day
    of the year, allowed or removed later, and some hosts a path entry besides.
    """
    host, _ = url_parts(F.col("url"))
    hosts = pages.select(host.alias("h")).where("h != ''").distinct()
    n = F.length("h")
    start = F.lit("2024-01-01").cast("date")
    row = lambda pattern, category, action, day: F.struct(
        pattern.alias("pattern"), F.lit(category).alias("category"), F.lit(action).alias("action"), F.date_add(start, day).alias("day")
    )
    rows = F.array(
        row(F.col("h"), "spam", "block", (n * 7) % 200),
        row(F.col("h"), "spam", "remove", (n * 7) % 200 + 90),
        row(F.concat("h", F.lit("/en")), "trusted", "allow", (n * 5) % 150),
        row(F.regexp_replace("h", r"^[^.]*\.", ""), "malware", "block", F.lit(300)),
        row(F.regexp_replace("h", r"^[^.]*\.", ""), "malware", "allow", F.lit(340)),
    )
    return hosts.select(F.inline(rows))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.select(
        F.col("page_id").alias("capture_id"),
        "url",
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int")).alias("fetched"),
    )
    out = filter_urls(captures, derived_entries(pages)).withColumnRenamed("capture_id", "page_id")
    return out.withColumn("fetched", F.date_format("fetched", "yyyy-MM-dd"))


OP2_SQL = r"""
WITH p AS (
  SELECT page_id, date '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS fetched,
         regexp_extract(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^[^?#]*', 0) AS place
  FROM pages
), c AS (
  SELECT page_id, fetched,
         lower(regexp_replace(regexp_replace(regexp_extract(place, '^[^/]*', 0), '^.*@', ''), ':[0-9]*$', '')) AS host,
         regexp_replace(place, '^[^/]*', '') AS path
  FROM p
), hosts AS (SELECT DISTINCT host AS h FROM c WHERE host != ''),
e AS (
  SELECT h AS pattern, 'spam' AS category, 'block' AS action, (length(h) * 7) % 200 AS d FROM hosts
  UNION ALL SELECT h, 'spam', 'remove', (length(h) * 7) % 200 + 90 FROM hosts
  UNION ALL SELECT h || '/en', 'trusted', 'allow', (length(h) * 5) % 150 FROM hosts
  UNION ALL SELECT regexp_replace(h, '^[^.]*[.]', ''), 'malware', 'block', 300 FROM hosts
  UNION ALL SELECT regexp_replace(h, '^[^.]*[.]', ''), 'malware', 'allow', 340 FROM hosts
), e1 AS (
  SELECT pattern, category, date '2024-01-01' + CAST(d AS INTEGER) AS day, max(action) AS action
  FROM e GROUP BY 1, 2, 3
), v AS (
  SELECT pattern, category, action, day AS since,
         lead(day) OVER (PARTITION BY pattern, category ORDER BY day) AS until
  FROM e1
), k AS (
  SELECT page_id, host, fetched, host AS pattern FROM c
  UNION SELECT page_id, host, fetched, regexp_replace(host, '^[^.]*[.]', '') FROM c
        WHERE length(host) - length(replace(host, '.', '')) >= 2
  UNION SELECT page_id, host, fetched, regexp_replace(host, '^[^.]*[.][^.]*[.]', '') FROM c
        WHERE length(host) - length(replace(host, '.', '')) >= 3
  UNION SELECT page_id, host, fetched, host || regexp_extract(path, '^/[^/]+', 0) FROM c
        WHERE regexp_extract(path, '^/[^/]+', 0) != ''
  UNION SELECT page_id, host, fetched, host || regexp_extract(path, '^/[^/]+/[^/]+', 0) FROM c
        WHERE regexp_extract(path, '^/[^/]+/[^/]+', 0) != ''
), j AS (
  SELECT k.page_id, k.host, k.fetched, v.pattern, v.category, v.action,
         row_number() OVER (PARTITION BY k.page_id ORDER BY length(v.pattern) DESC, v.action, v.category, v.pattern) AS rn,
         count(v.pattern) OVER (PARTITION BY k.page_id) AS n_active
  FROM k LEFT JOIN v ON k.pattern = v.pattern AND v.action IN ('block', 'allow')
       AND k.fetched >= v.since AND (v.until IS NULL OR k.fetched < v.until)
), b AS (SELECT * FROM j WHERE rn = 1)
SELECT c.page_id, c.host, strftime(c.fetched, '%Y-%m-%d') AS fetched, coalesce(b.n_active, 0) AS n_active,
       b.pattern, b.category, b.action, coalesce(b.action = 'block', false) AS blocked
FROM c JOIN b ON b.page_id = c.page_id
"""
