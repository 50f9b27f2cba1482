"""Personal data: patterns propose spans, checksums confirm them, context adjusts their score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Kinds in the order in which spans that start together are listed. The patterns never try a run
#: of characters twice (possessive repeats, a look behind at a run's start), so they stay linear
#: on long texts; each finds what its plain form in the README finds.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
#: What a text must hold for the pattern to be worth trying.
HINTS = {"email": "@", "ip": ".", "phone": "+"}
BASE = ("email", "ip", "card", "phone")
#: Score of a confirmed span without context words, and what one such word near it adds.
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.9}
CONTEXT = {
    "email": r"(?i)\b(e-?mail|mail|contact|write)\b",
    "ip": r"(?i)\b(ip|host|server|address|login)\b",
    "card": r"(?i)\b(card|visa|credit|payment|pay)\b",
    "phone": r"(?i)\b(phone|tel|call|mobile|fax)\b",
    "iban": r"(?i)\b(iban|bank|account|transfer)\b",
}
CONTEXT_CHARS = 48
CONTEXT_BONUS = 0.2
#: Lengths of the arrays that running sums are taken over at once, and of the pieces of text that context is taken from.
RUN = 256


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` worked out once, also where lambdas inside ``then`` name it."""
    return F.transform(F.array(value), then)[0]


def chars(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit("."), F.lit(0))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    d = F.transform(chars(F.reverse(digits)), lambda x: x.cast("int"))
    twice = F.transform(d, lambda x, i: F.when(i % 2 == 1, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x))
    return F.aggregate(twice, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without blanks has remainder 1, letters counting from A = 10."""
    moved = F.concat(F.substring(iban, 5, 1000), F.substring(iban, 1, 4))
    value = lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    return (
        F.aggregate(
            chars(moved),
            F.lit(0),
            lambda a, c: ((a * F.when(c >= "A", 100).otherwise(10) + value(c)) % 97).cast("int"),
        )
        == 1
    )


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        # at most three digits after leading zeros, and at most 255
        return F.forall(F.split(s, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(digits(s)).between(14, 19) & luhn(digits(s))
    if kind == "phone":
        return F.length(digits(s)).between(10, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(s, " ", "")) & F.length(F.regexp_replace(s, " ", "")).between(15, 34)
    return F.lit(True)


def running(lengths: Column) -> Column:
    """Sums of all lengths before each place, in runs of ``RUN`` so that long arrays stay cheap."""
    none = F.array().cast("array<long>")
    push = lambda a, x: F.struct(
        F.concat(a["out"], F.array(a["sum"])).alias("out"), (a["sum"] + x).alias("sum")
    )
    start = F.struct(none.alias("out"), F.lit(0).cast("long").alias("sum"))
    scan = lambda arr: F.aggregate(arr, start, push)
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(lengths) - 1) / RUN), F.lit(0)).cast("int")),
        lambda i: scan(F.slice(lengths, i * RUN + 1, RUN)),
    )
    add = lambda runs: F.flatten(
        F.zip_with(
            runs, scan(F.transform(runs, lambda r: r["sum"]))["out"], lambda r, b: F.transform(r["out"], lambda x: x + b)
        )
    )
    return let(runs, add)


def spans_of(kind: str, text: Column) -> Column:
    """Confirmed spans of one kind: start and end in code points, and score.

    Context words count in the CONTEXT_CHARS characters before and after a span, whatever spans are there.
    """
    pattern = PATTERNS[kind]

    def part(chunks: Column, lo: Column, n: Column) -> Column:
        at = F.floor(lo / RUN)  # n is less than a chunk, so two hold it
        return F.substring(F.array_join(F.slice(chunks, (at + 1).cast("int"), F.lit(2)), ""), (lo - at * RUN + 1).cast("int"), n.cast("int"))

    def near(chunks: Column, p: Column) -> Column:
        first = F.greatest(p["start"] - CONTEXT_CHARS, F.lit(0).cast("long"))
        before = part(chunks, first, p["start"] - first)
        after = part(chunks, p["start"] + F.length(p["match"]), F.lit(CONTEXT_CHARS))
        return before.rlike(CONTEXT[kind]) | after.rlike(CONTEXT[kind])

    def place(pieces: Column) -> Column:
        lengths = F.transform(pieces, lambda p: (F.length(p["before"]) + F.length(p["match"])).cast("long"))
        return F.zip_with(
            pieces,
            let(lengths, running),
            lambda p, at: F.struct(
                (at + F.length(p["before"])).alias("start"), p["before"].alias("before"), p["match"].alias("match")
            ),
        )

    # what stands before each match since the last one, and the match, make up the text
    pieces = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.zip_with(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)),
            found,
            lambda b, m: F.struct(b.alias("before"), m.alias("match")),
        ),
    )
    spans = lambda chunks: F.transform(
        F.filter(let(pieces, place), lambda p: valid(kind, p["match"])),
        lambda p: F.struct(
            p["start"].alias("start"),
            F.lit(list(PATTERNS).index(kind)).alias("rank"),
            F.lit(kind).alias("kind"),
            (p["start"] + F.length(p["match"])).alias("end"),
            F.least(F.lit(1.0), F.lit(SCORES[kind]) + F.when(near(chunks, p), CONTEXT_BONUS).otherwise(0.0)).alias("score"),
        ),
    )
    spans = let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{RUN}}}"), F.lit(0)), spans)
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,score:double>>")
    hint = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else F.lit(True)
    return F.when(hint & text.rlike(pattern), spans).otherwise(none)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Adds ``spans``: array of (start, rank, kind, end, score), by start and then by kind.

    Works on whole texts row by row, without a shuffle. A null text is an empty one and has no
    spans; every other column stays as it is, so ``docs`` mustn't have one named spans.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    every = reduce(F.concat, [spans_of(k, text) for k in PATTERNS])
    return docs.withColumn("spans", F.array_sort(every))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    spans = F.col("spans")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(count(k).alias(f"n_{k}") for k in PATTERNS),
        F.sha2(joined(F.filter(spans, lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
        F.array_max(F.transform(spans, lambda s: s["score"])).alias("top_score"),
    )
