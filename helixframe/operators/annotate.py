"""Annotation: features from alignments by read name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_alignments(alignments: DataFrame) -> DataFrame:
    """(readname, feature) of each read's first alignment, by place in the file (column ord)."""
    return alignments.groupBy("readname").agg(F.min_by("feature", "ord").alias("feature"))


def annotate(rows: DataFrame, alignments: DataFrame, name: str = "c0") -> DataFrame:
    """``rows`` with ``feature`` of the read named in column ``name``; reads without one are dropped.

    Of several alignments of a read the first counts; "-", empty and missing features are none.
    """
    named = first_alignments(alignments).where("feature is not null and feature not in ('', '-')")
    named = named.withColumnRenamed("readname", "__readname")
    return rows.join(named, rows[name] == named["__readname"], "inner").drop("__readname")
