"""Sinks: tables as text files or Parquet in any store that Spark writes."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str, header: Sequence[str] | None = None) -> None:
    """A folder of tab-separated parts, each with a header; nulls are empty."""
    names = list(header or df.columns)
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    # positions, not names: a header may repeat a name
    lines = df.select(F.concat_ws("\t", *cells).alias("\t".join(names)))
    lines.write.mode("overwrite").option("header", "true").option("quote", "\0").option("sep", "\1").option("emptyValue", "").csv(path)


def write_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)


def write_failed(reads: DataFrame, path: str) -> None:
    """Sequences of failed reads: one file, or FW and RV folders for pairs."""
    if "seq_rv" in reads.columns:
        write_lines(reads.select("seq"), f"{path}_FW")
        write_lines(reads.select("seq_rv"), f"{path}_RV")
    else:
        write_lines(reads.select("seq"), path)


def write_parameters(spark, config: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(config, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)
