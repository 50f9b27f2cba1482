"""Quality tables of a demultiplexing run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.pattern import Kind, Pattern


def _keys(spark: SparkSession, patterns: Sequence[Pattern]) -> DataFrame:
    """(pattern, position, place, barcode, most): every barcode that a table must show.

    position numbers the emitted elements; random ones count but aren't shown.
    """
    rows = []
    for p in patterns:
        emitted = [e for e in p.elements if e.emitted]
        for i, e in enumerate(emitted):
            if e.kind is Kind.RANDOM:
                continue
            for b in dict.fromkeys(e.barcodes if e.kind is Kind.LIST else (e.name,)):
                rows.append((p.name, i, b, e.max_edits))
    return spark.createDataFrame(rows, "pattern string, position int, barcode string, most int")


def _per_barcode(rows: DataFrame, patterns: Sequence[Pattern]) -> DataFrame:
    names = F.array(*(F.lit(p.name) for p in patterns))
    each = rows.where("pattern_idx >= 0").select(
        names[F.col("pattern_idx")].alias("pattern"),
        F.posexplode(F.arrays_zip("barcodes", "edits")).alias("position", "x"),
    )
    return each.select(
        "pattern", "position", F.col("x.barcodes").alias("barcode"),
        F.col("x.edits.ins").alias("ins"), F.col("x.edits.del").alias("del"), F.col("x.edits.sub").alias("sub"),
    )


def edit_counts(rows: DataFrame, patterns: Sequence[Pattern]) -> DataFrame:
    """PATTERN, POSITION, BARCODE, 0MM, 1MM, ...: reads by barcode and total edits.

    Every listed barcode has a row; columns beyond an element's own allowance hold "-".
    """
    keys = _keys(rows.sparkSession, patterns)
    most = max((e.max_edits for p in patterns for e in p.elements), default=0)
    edits = F.col("ins") + F.col("del") + F.col("sub")
    counts = _per_barcode(rows, patterns).groupBy("pattern", "position", "barcode").agg(
        *(F.sum(F.when(edits == k, 1).otherwise(0)).alias(f"n{k}") for k in range(most + 1))
    )
    cell = lambda k: F.when(F.col("most") >= k, F.coalesce(F.col(f"n{k}"), F.lit(0)).cast("string")).otherwise("-")
    return keys.join(counts, ["pattern", "position", "barcode"], "left").select(
        F.col("pattern").alias("PATTERN"), F.col("position").alias("POSITION"), F.col("barcode").alias("BARCODE"),
        *(cell(k).alias(f"{k}MM") for k in range(most + 1)),
    )


def edit_types(rows: DataFrame, patterns: Sequence[Pattern]) -> DataFrame:
    """PATTERN, POSITION, BARCODE, MISMATCH_TYPE, COUNT: edits by barcode and type."""
    keys = _keys(rows.sparkSession, patterns).drop("most")
    sums = _per_barcode(rows, patterns).groupBy("pattern", "position", "barcode").agg(
        *(F.sum(c).alias(c) for c in ("ins", "del", "sub"))
    )
    n = lambda c: f"coalesce({c}, 0L)"
    return keys.join(sums, ["pattern", "position", "barcode"], "left").selectExpr(
        "pattern AS PATTERN", "position AS POSITION", "barcode AS BARCODE",
        f"stack(3, 'INSERTION', {n('ins')}, 'DELETION', {n('del')}, 'SUBSTITUTION', {n('sub')}) AS (MISMATCH_TYPE, COUNT)",
    )


def failing_positions(rows: DataFrame, patterns: Sequence[Pattern], paired: bool = False) -> DataFrame:
    """PATTERN, POSITION, READ_DIRECTION, COUNT: the first element that failed, by read.

    Only with a single pattern; with more the table is empty. Positions of the second read count
    from the pattern's end. Positions where nothing failed have a row of 0.
    """
    spark = rows.sparkSession
    if len(patterns) != 1:
        return spark.createDataFrame([], "PATTERN string, POSITION int, READ_DIRECTION string, COUNT long")
    p = patterns[0]
    sides = [("FORWARD_READ", "fail_fw")] + ([("REVERSE_READ", "fail_rv")] if paired else [])
    fails = rows.where("pattern_idx < 0").select(
        F.explode(F.array(*(F.struct(F.lit(d).alias("d"), F.col(c).alias("i")) for d, c in sides))).alias("x")
    )
    counts = fails.where("x.i is not null").groupBy("x.d", "x.i").agg(F.count("*").alias("n"))
    every = spark.createDataFrame([(d, i) for d, _ in sides for i in range(len(p.elements))], "d string, i int")
    return every.join(counts, ["d", "i"], "left").select(
        F.lit(p.name).alias("PATTERN"), F.col("i").alias("POSITION"), F.col("d").alias("READ_DIRECTION"),
        F.coalesce("n", F.lit(0)).cast("long").alias("COUNT"),
    )


def summary(rows: DataFrame) -> DataFrame:
    """One row: reads, and how many matched without edits, with some, and not; percentages cut to integers."""
    ok = F.col("pattern_idx") >= 0
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    one = rows.agg(
        F.count("*").alias("total"), n(ok & (F.col("score") == 0)).alias("perfect"),
        n(ok & (F.col("score") > 0)).alias("moderate"), n(~ok).alias("failed"),
    )
    share = lambda c: F.when(F.col("total") > 0, F.floor(F.lit(100) * F.col(c) / F.col("total"))).otherwise(0).cast("long")
    return one.select("*", *(share(c).alias(f"{c}_percent") for c in ("perfect", "moderate", "failed")))
