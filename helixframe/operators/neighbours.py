"""Whitelists with their error neighbourhoods as small tables to join reads with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Letters that substitutions and insertions of the neighbourhoods try.
LETTERS = "ATGCN"


def whitelist_table(spark: SparkSession, barcodes: list[str] | tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(barcodes)), "idx int, barcode string")


def _edited(whitelist: DataFrame, kind: str) -> DataFrame:
    letters = F.array(*(F.lit(x) for x in LETTERS))
    b, n = F.col("barcode"), F.length("barcode")
    last = n if kind == "insertion" else n - 1
    at = whitelist.select("idx", "barcode", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    head = lambda i: F.substring(b, F.lit(1), i)
    if kind == "deletion":
        return at.select("idx", "barcode", F.concat(head(F.col("i")), F.substring(b, F.col("i") + 2, n)).alias("key"))
    at = at.select("*", F.explode(letters).alias("x"))
    if kind == "insertion":
        tail = F.substring(b, F.col("i") + 1, n)
    else:
        at = at.where(F.col("x") != F.substring(b, F.col("i") + 1, F.lit(1)))
        tail = F.substring(b, F.col("i") + 2, n)
    return at.select("idx", "barcode", F.concat(head(F.col("i")), F.col("x"), tail).alias("key"))


def exact(whitelist: DataFrame) -> DataFrame:
    """(key, barcode): each barcode once."""
    return whitelist.groupBy("barcode").agg(F.min("idx").alias("idx")).select(F.col("barcode").alias("key"), "barcode")


def substitutions(whitelist: DataFrame) -> DataFrame:
    """(key, barcode, ambiguous) of words one substitution away; a word reached twice is ambiguous."""
    return _edited(whitelist, "substitution").groupBy("key").agg(
        F.min("barcode").alias("barcode"), (F.count("*") > 1).alias("ambiguous")
    )


def indels(whitelist: DataFrame, kind: str) -> DataFrame:
    """(key, barcode) of words one "insertion" or "deletion" away from just one barcode."""
    near = _edited(whitelist, kind).groupBy("key").agg(
        F.min("barcode").alias("barcode"), F.max("barcode").alias("other")
    )
    return near.where("barcode = other").select("key", "barcode")


def lookup(reads: DataFrame, whitelist: DataFrame, seq: str, start: int, length: int, max_edits: int, use_indels: bool = True) -> DataFrame:
    """``reads`` with barcode, consumed, insertions, deletions, substitutions of a list element at ``start``.

    The list's barcodes are all ``length`` long; at most one edit is looked for, in the order
    exact, one substitution, one insertion or deletion. An ambiguous word fails at once, and so
    does one that an insertion and a deletion of the same barcode both explain. barcode is null
    where nothing fits. All joins are on small tables, and Spark broadcasts them by their size.
    """
    window = lambda n: F.when(
        F.length(F.col(seq)) >= start + n, F.substring(F.col(seq), start + 1, n)
    )
    def joined(df: DataFrame, table: DataFrame, n: int, tag: str) -> DataFrame:
        t = table.select(*(F.col(c).alias(f"__{tag}_{c}") for c in table.columns))
        return df.join(t, window(n) == t[f"__{tag}_key"], "left")

    out = joined(reads, exact(whitelist), length, "e")
    b, sub = F.col("__e_barcode"), F.lit(None).cast("string")
    ins = dele = F.lit(None).cast("string")
    ambiguous = F.lit(False)
    if max_edits:
        out = joined(out, substitutions(whitelist), length, "s")
        ambiguous = F.coalesce(F.col("__s_ambiguous"), F.lit(False))
        sub = F.when(~ambiguous, F.col("__s_barcode"))
        if use_indels:
            out = joined(joined(out, indels(whitelist, "insertion"), length + 1, "i"), indels(whitelist, "deletion"), length - 1, "d")
            ins, dele = F.col("__i_barcode"), F.col("__d_barcode")
    open_ = b.isNull() & sub.isNull() & ~ambiguous
    one = open_ & ~ins.eqNullSafe(dele)
    by_ins, by_del = one & ins.isNotNull(), one & ins.isNull() & dele.isNotNull()
    n = F.lit(length)
    return out.select(
        *reads.columns,
        F.coalesce(b, sub, F.when(by_ins, ins), F.when(by_del, dele)).alias("barcode"),
        F.when(by_ins, n + 1).when(by_del, n - 1).when(b.isNotNull() | sub.isNotNull(), n).alias("consumed"),
        by_ins.cast("int").alias("insertions"),
        by_del.cast("int").alias("deletions"),
        (b.isNull() & sub.isNotNull()).cast("int").alias("substitutions"),
    )
