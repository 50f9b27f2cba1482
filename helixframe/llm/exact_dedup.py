"""Exact deduplication by deterministic block naming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop, one_each, saved, table, without

#: Characters of a block.
BLOCK = 4096
WHITE = r"[\x20\x09-\x0D]+"


def _named(keys: DataFrame, by: list[str]) -> DataFrame:
    """Distinct ``keys`` with integer names in their sorted order.

    Range partitioning and a sort inside each partition order all keys; the partition number and
    the row's place in it make the name, so no task sees more than its range.
    """
    return saved(keys.orderBy(*by).withColumn("name", F.monotonically_increasing_id()), "names")


def identities(docs: DataFrame, text: str = "text", block: int = BLOCK) -> DataFrame:
    """Columns of ``docs`` but ``text``, and (levels, name): equal for equal texts and no others.

    Level 0 cuts each text into blocks of ``block`` characters and names the distinct blocks with
    integers in sorted order: by their 64-bit hash, and by the block itself where two blocks share
    a hash, so a name stands for one block only. Each further level names adjacent pairs of names
    (an odd last one pairs with none) until one name is left. Texts that end on different levels
    have different lengths in blocks, so the level is part of the identity.

    An empty text is one empty block. Blocks cross to other tasks once, after each task has
    dropped its repeats; all else moves integers.
    """
    rest = [c for c in docs.columns if c != text]
    blocks = F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(F.col(text), F.lit("(?s).{1,%d}" % block), F.lit(0))
    )
    cut = docs.select(*rest, blocks.alias("_blocks"))
    each = docs.select(F.explode(blocks).alias("_block")).select(F.xxhash64("_block").alias("_h"), "_block").distinct()
    hashes = saved(each.groupBy("_h").agg(F.count("*").alias("_n")), "hashes")
    shared = hashes.where("_n > 1").select("_h", F.lit(True).alias("_twice"))
    collided = shared.limit(1).count() > 0
    keys = hashes.where("_n = 1").select("_h", F.lit("").alias("_tie"))
    if collided:  # the block itself tells apart those that share a hash
        keys = keys.unionByName(each.join(shared, "_h", "left_semi").withColumnRenamed("_block", "_tie"))
    names = _named(keys, ["_h", "_tie"])
    occ = cut.select(*rest, F.size("_blocks").alias("_size"), F.posexplode("_blocks").alias("_i", "_block")).withColumn(
        "_h", F.xxhash64("_block")
    )
    if collided:
        occ = occ.join(shared, "_h", "left").withColumn("_tie", F.when(F.col("_twice"), F.col("_block")).otherwise(""))
    else:
        occ = occ.withColumn("_tie", F.lit(""))
    level0 = saved(
        occ.select(*rest, "_size", "_i", "_h", "_tie").join(names, ["_h", "_tie"]).drop("_h", "_tie"),
        "level0",
    )
    drop(hashes)
    drop(names)
    done = level0.where("_size = 1").select(*rest, F.lit(0).alias("levels"), "name")
    todo = level0.where("_size > 1").select(*rest, "_size", "_i", "name")
    level = 0
    while todo.limit(1).count():
        level += 1
        half = F.floor(F.col("_i") / 2).cast("int")
        pairs = todo.groupBy(*rest, "_size", half.alias("_i")).agg(
            F.max(F.when(F.col("_i") % 2 == 0, F.col("name"))).alias("_l"),
            F.max(F.when(F.col("_i") % 2 == 1, F.col("name"))).alias("_r"),
        ).withColumn("_r", F.coalesce("_r", F.lit(-1)))
        pairs = saved(pairs, "pairs")
        names = _named(pairs.select("_l", "_r").distinct(), ["_l", "_r"])
        up = saved(
            pairs.join(names, ["_l", "_r"]).select(*rest, F.ceil(F.col("_size") / 2).cast("int").alias("_size"), "_i", "name"),
            f"level{level}",
        )
        drop(pairs)
        drop(names)
        done = done.unionByName(up.where("_size = 1").select(*rest, F.lit(level).alias("levels"), "name"))
        todo = up.where("_size > 1")
    return done


def mark_copies(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): keep_id, group_size, kept, text_sha256.

    Texts are equal when they are so without ASCII white space; a null text is an empty one. Of
    equal texts the row with the most code points in its original text stays, then the smallest
    doc_id; of rows that repeat both, one. A null doc_id sorts last. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = F.regexp_replace(text, WHITE, "")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.length(text).alias("n"),
        F.sha2(plain, 256).alias("text_sha256"),
        plain.alias("text"),
    )
    named = saved(identities(rows), "identities")
    order = F.struct(
        (-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row")
    )
    groups = named.groupBy("levels", "name").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
    return named.join(groups, ["levels", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
        F.col("n").cast("long").alias("n_code_points"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``mark_copies`` drops; all columns stay.

    A row is known by its doc_id, length and normalised text; of rows that repeat all three one stays.
    """
    keys = ["__helix_id", "__helix_n", "__helix_sha256"]
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns({
        "__helix_id": F.col("doc_id").cast("long"), "__helix_n": F.length(text).cast("long"),
        "__helix_sha256": F.sha2(F.regexp_replace(text, WHITE, ""), 256),
    })
    marks = mark_copies(docs).select(*(F.col(c).alias(k) for c, k in zip(("doc_id", "n_code_points", "text_sha256"), keys, strict=True)), "kept")
    rows = saved(marks.groupBy(*keys).agg(F.max("kept").alias("kept"), F.count("*").alias("rows")).where("not kept or rows > 1"), "lost")
    kept = without(keyed, rows.where("not kept"), keys)
    return one_each(kept, rows.where("kept"), keys).drop(*keys)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("n_code_points")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t
  FROM documents
), r AS (
  SELECT doc_id, t,
         first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY t) AS group_size,
         row_number() OVER w = 1 AS kept
  FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, kept, sha256(t) AS text_sha256 FROM r
"""
