"""License scans: phrases, and an exact set-similarity join of text blocks with templates."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table
from .pii import let

#: Fixed phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices to look for, and their labels: a parameter of fixed length, so it can be broadcast.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "mit": "released under the mit license",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "cc-by-4.0": "licensed under cc by 4 0",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
#: Most templates that a call takes; beyond it they would be no small side any more.
MAX_TEMPLATES = 10_000
#: Most bytes that the broadcast prefix rows may hold; each carries its template's distinct tokens.
MAX_PREFIX_BYTES = 64 << 20
#: Share of a template's distinct tokens that a block must hold.
CONTAINMENT = 0.8
#: What stands between words (after lower-casing), line ends aside.
GAP = r"[\x00-\x09\x0B\x0C\x0E-\x2F\x3A-\x60\x7B-\x7F]+"


def spaces(s: Column) -> Column:
    return (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))).cast("long")


def template_tokens(spark: SparkSession, templates: dict[str, str], containment: float) -> DataFrame:
    """(label, size, need, most, token), a row for each distinct token.

    ``most`` is the length in words of a run that holds ``containment`` of a template's words.
    """
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    rows, held = [], 0
    for label, text in templates.items():
        tokens = sorted(set(text.split()))
        prefix = len(tokens) - math.ceil(containment * len(tokens) - 1e-9) + 1
        held += prefix * sum(len(t.encode()) + 16 for t in tokens)
        if held > MAX_PREFIX_BYTES:
            raise ValueError(f"templates whose prefixes take more than {MAX_PREFIX_BYTES} bytes")
        most = math.ceil(len(text.split()) / containment - 1e-9)
        rows += [(label, len(tokens), math.ceil(containment * len(tokens) - 1e-9), most, t) for t in tokens]
    return spark.createDataFrame(rows, "label string, size int, need int, most int, token string")


def wrapped_blocks(clean: Column, known: list[str], reach: int) -> Column:
    """Blocks around line ends: the known ones of the ``reach`` words before each and after it, with their places.

    Every run of ``reach`` words that goes over a line end is in one of them, however many line
    ends it goes over. Blocks are numbered -1, -2, ... along the text; blank lines end nothing.
    """
    one = F.regexp_replace(F.btrim(clean, F.lit(" \n\r")), r" ?[\n\r][ \n\r]*", "\n ")  # a line end stays with its last word
    near = lambda words, i: F.slice(words, F.greatest(i + 2 - reach, F.lit(1)), reach + F.least(i + 1, F.lit(reach)))
    run = lambda words, i: F.filter(
        F.transform(near(words, i), lambda w, j: F.struct(F.rtrim(w, F.lit("\n")).alias("token"), j.alias("place"))),
        lambda x: x["token"].isin(known),
    )
    ends = lambda words: F.filter(F.transform(words, lambda w, i: F.when(F.endswith(w, F.lit("\n")), run(words, i))), lambda t: t.isNotNull())
    return F.transform(
        let(F.split(one, " "), ends),
        lambda t, i: F.struct((-1 - i).alias("block"), F.array_distinct(t["token"]).alias("tokens"), t.alias("run")),
    )


def match_templates(blocks: DataFrame, templates: dict[str, str], containment: float = CONTAINMENT) -> DataFrame:
    """(row, block, label, score) of each block holding ``containment`` of a template's tokens, exactly.

    ``blocks`` has row, block and tokens, the block's distinct words; words of no template may be
    missing, as they add to no overlap. Tokens are ordered from the rarest to the most frequent
    over all blocks. A block with ``need`` of a template's ``size`` tokens has one of the first
    ``size - need + 1`` in that order, so the join is on those alone; the length filter drops
    blocks with under ``need`` tokens, and the positional filter pairs whose first shared token
    leaves too few behind it. Where ``blocks`` has run (words and their places, null for a line),
    the words must stand within ``most`` words of each other.
    """
    if "run" not in blocks.columns:
        blocks = blocks.withColumn("run", F.lit(None).cast("array<struct<token:string,place:int>>"))
    parts = template_tokens(blocks.sparkSession, templates, containment)
    counts = blocks.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    ordered = (
        parts.join(counts, "token", "left")
        .groupBy("label", "size", "need", "most")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))).alias("all"))
        .select("label", "size", "need", "most", F.col("all.token").alias("template"))
    )
    prefix = ordered.select(
        "*", F.posexplode(F.slice("template", F.lit(1), F.col("size") - F.col("need") + 1)).alias("place", "token")
    )
    overlap = F.size(F.array_intersect("tokens", "template"))
    within = lambda r: F.filter("run", lambda x: (x["place"] >= r["place"]) & (x["place"] < r["place"] + F.col("most")))
    best = F.array_max(F.transform("run", lambda r: F.size(F.array_intersect(within(r)["token"], F.col("template")))))
    return (
        blocks.select("row", "block", "tokens", "run", F.explode("tokens").alias("token"))
        .join(F.broadcast(prefix), "token")
        .where((F.size("tokens") >= F.col("need")) & (F.col("size") - F.col("place") >= F.col("need")))
        # several shared prefix tokens: the pair counts where the first of them stands
        .where(~F.arrays_overlap("tokens", F.slice("template", F.lit(1), F.col("place"))))
        .where(overlap >= F.col("need"))
        .select("row", "block", "label", "size", "need", F.when(F.col("run").isNull(), overlap).otherwise(best).alias("shared"))
        .where("shared >= need")
        .select("row", "block", "label", (F.col("shared") / F.col("size")).alias("score"))
    )


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT, wrapped: bool = False
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, places of the phrases, and labels.

    Columns: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches
    (array of block, label, score; blocks are lines, numbered from 0). A null text is an empty
    one: no words, no labels, score 0. Repeated rows each give a row. A phrase scores 1, else the
    score is the best containment of a template in a line. Other columns of ``docs`` are ignored.

    With ``wrapped`` notices may go over line ends, too: a label that no line gives alone is given
    where a run of words over a line end holds its template, which may be longer than the template
    by as much as ``containment`` allows. The blocks of such matches are negative, as in
    ``wrapped_blocks``.
    """
    templates = TEMPLATES if templates is None else templates
    least = min((math.ceil(containment * len(set(t.split())) - 1e-9) for t in templates.values()), default=1)
    tokens = sorted({t for x in templates.values() for t in x.split()})
    known = "|".join(re.escape(t) for t in tokens)
    reach = math.ceil(max((len(t.split()) for t in templates.values()), default=1) / containment - 1e-9)
    clean = F.regexp_replace(F.lower(F.coalesce(F.col("text"), F.lit(""))), GAP, " ")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean.alias("clean"))
    padded = F.concat(F.lit(" "), F.trim(F.regexp_replace("clean", r"[ \n\r]+", " ")), F.lit(" "))
    texts = texts.select(
        "clean",
        "doc_id",
        padded.alias("padded"),
        F.transform(
            F.split("clean", r"[\n\r]+"),
            lambda line, i: F.struct(
                i.alias("block"),
                F.array_distinct(
                    F.regexp_extract_all(F.concat(line, F.lit(" ")), F.lit(rf"(?<![^ ])(?:{known})(?= )"), F.lit(0))
                ).alias("tokens"),
            ),
        ).alias("lines"),
    )
    none = F.array().cast("array<struct<block:int,tokens:array<string>,run:array<struct<token:string,place:int>>>>")
    over = none
    if wrapped and templates:  # only where all lines together hold a template
        sets = [sorted(set(t.split())) for t in templates.values()]
        parts = F.array(*(F.struct(F.lit(math.ceil(containment * len(t) - 1e-9)).alias("need"), F.lit(t).alias("tokens")) for t in sets))
        holds = let(
            F.array_distinct(F.flatten("lines.tokens")),
            lambda have: (F.size(have) >= least) & F.exists(parts, lambda t: F.size(F.array_intersect(have, t["tokens"])) >= t["need"]),
        )
        several = F.size("lines") > 1
        over = F.when(several & holds, wrapped_blocks(F.col("clean"), tokens, reach)).otherwise(none)
    no_run = F.lit(None).cast("array<struct<token:string,place:int>>")
    lines = F.transform("lines", lambda b: F.struct(b["block"].alias("block"), b["tokens"].alias("tokens"), no_run.alias("run")))
    texts = texts.select("doc_id", "padded", F.filter(F.concat(lines, over), lambda b: F.size(b["tokens"]) >= least).alias("blocks"))
    found = {}
    for phrase, label in PHRASES.items():
        cut = F.split("padded", f" {phrase}(?= )", -1)  # a phrase overlaps no other place of its own
        has = F.contains("padded", F.lit(f" {phrase} "))
        n = F.size(cut) - 1
        length = len(phrase.split())
        before = F.aggregate(F.slice(cut, F.lit(1), n), F.lit(0).cast("long"), lambda a, p: a + spaces(p))
        found[label] = F.when(
            has,
            F.struct(
                n.cast("long").alias("n"),
                spaces(cut[0]).alias("first"),
                (before + (n - 1) * length).alias("last"),
            ),
        )
    texts = texts.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.when(F.length(F.trim("padded")) == 0, F.lit(0).cast("long")).otherwise(spaces(F.col("padded")) - 1).alias("n_words"),
        F.array(*found.values()).alias("places"),
        "blocks",
    )
    texts = saved(texts, "license_rows")  # the row numbers hold from here on
    blocks = texts.select("row", F.explode("blocks").alias("b")).select("row", "b.block", "b.tokens", "b.run")
    matches = (
        match_templates(blocks, templates, containment)
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("block", "label", "score"))).alias("matches"))
    )
    if wrapped:  # a line end counts for labels that no line gives alone
        lines = F.filter("matches", lambda m: m["block"] >= 0)
        matches = matches.withColumn("lines", lines["label"]).select(
            "row", F.filter("matches", lambda m: (m["block"] >= 0) | ~F.array_contains("lines", m["label"])).alias("matches")
        )
    names = F.array(*(F.lit(x) for x in found))
    base = F.array_sort(F.array_distinct(F.filter(F.zip_with(names, "places", lambda a, p: F.when(p.isNotNull(), a)), lambda a: a.isNotNull())))
    hits = F.filter("places", lambda p: p.isNotNull())
    none = F.array().cast("array<struct<block:int,label:string,score:double>>")
    out = texts.drop("blocks").join(matches, "row", "left").withColumn("matches", F.coalesce("matches", none))
    every = F.array_sort(F.array_distinct(F.concat(base, F.col("matches.label"))))
    return out.select(
        "doc_id",
        "n_words",
        F.aggregate(hits, F.lit(0).cast("long"), lambda a, p: a + p["n"]).alias("n_base"),
        F.array_min(F.transform(hits, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(hits, lambda p: p["last"])).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size(hits) > 0, 1.0).otherwise(F.coalesce(F.array_max(F.col("matches.score")), F.lit(0.0))).alias("score"),
        "matches",
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), wrapped=True).drop("matches")
