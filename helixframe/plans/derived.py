"""Reads, whitelists and counting rows derived from the relational tables, in SQL for both engines.

The tables hold no reads. These expressions build some with known errors, and are written so that
only integer division and array indexing differ between the engines' dialects.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LINKER = "GATTACAG"


def kmer(number: str, length: int, div: str) -> str:
    """A number in base 4, letters ACGT, lowest digit first."""
    return " || ".join(
        f"substring('ACGT', CAST(1 + (({number}) {div} {4**i}) % 4 AS INT), 1)" for i in range(length)
    )


def code(number: str, div: str) -> str:
    """An 8-letter barcode; keys under 128 give barcodes several edits apart."""
    return kmer(f"({number}) * 2437 + 11939", 8, div)


def reads_sql(div: str) -> str:
    """read_id and seq: barcode of l_suppkey % 25, linker, 6-letter UMI, barcode of l_orderkey % 5.

    l_linenumber % 6 says what is wrong: 1 a substitution, 2 a deletion and 3 an insertion in the
    first barcode, 4 a substitution in the linker, 5 a substitution in the second barcode.
    """
    a, b = code("l_suppkey % 25", div), code("100 + l_orderkey % 5", div)
    umi = kmer("(l_partkey * 7 + l_orderkey % 3) % 4096", 6, div)
    flip = "translate(substring(a, 4, 1), 'ACGT', 'CGTA')"
    flip_b = "translate(substring(b, 2, 1), 'ACGT', 'GTAC')"
    return f"""
      SELECT read_id, kind, umi,
             CASE kind WHEN 1 THEN substring(a, 1, 3) || {flip} || substring(a, 5, 4)
                       WHEN 2 THEN substring(a, 1, 3) || substring(a, 5, 4)
                       WHEN 3 THEN substring(a, 1, 3) || 'N' || substring(a, 4, 5)
                       ELSE a END
             || CASE kind WHEN 4 THEN 'GATTTCAG' ELSE '{LINKER}' END
             || umi
             || CASE kind WHEN 5 THEN substring(b, 1, 1) || {flip_b} || substring(b, 3, 6) ELSE b END AS seq
      FROM (SELECT (l_orderkey * 8 + l_linenumber) * 1000003 + l_partkey * 101 + l_suppkey AS read_id, l_linenumber % 6 AS kind,
                   {a} AS a, {umi} AS umi, {b} AS b
            FROM lineitem) AS source"""


def whitelist_sql(n: int, base: int, div: str) -> str:
    """(idx, barcode) from the keys of nation; ``n`` of at most 25."""
    return f"SELECT CAST(n_nationkey AS INT) AS idx, {code(f'{base} + n_nationkey', div)} AS barcode FROM nation WHERE n_nationkey < {n}"


def counting_sql(div: str) -> str:
    """row_id, umi, feature, cell: many rows share a UMI, some of them across cells and features."""
    return f"""
      SELECT l_orderkey * 8 + l_linenumber AS row_id,
             {kmer("(l_partkey * 3 + l_linenumber % 2) % 256", 4, div)} AS umi,
             l_suppkey % 7 AS feature_idx, l_orderkey % 5 AS cell_a, l_linenumber % 3 AS cell_b
      FROM lineitem"""


def register(spark: SparkSession, sf_dir: str, *tables: str) -> None:
    for t in tables:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def spark_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    register(spark, sf_dir, "lineitem", "nation", "region", "supplier", "part")
    return spark.sql(sql)


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, reads_sql("div"))


def barcodes(n: int, base: int) -> tuple[str, ...]:
    """The barcodes of ``whitelist_sql`` in Python."""

    def one(k: int) -> str:
        v = (base + k) * 2437 + 11939
        return "".join("ACGT"[v // 4**i % 4] for i in range(8))

    return tuple(one(k) for k in range(n))


def work_path(spark: SparkSession, name: str) -> str:
    """A new place for files of a query: below the checkpoint folder, or the warehouse where that is unset."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{found.rstrip('/')}/helixframe/{name}-{uuid.uuid4().hex}"
