"""Demultiplexing of a stream of reads. Matching is stateless, so a stream needs no state or watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.demux import READ, demultiplex
from ..operators.matching import MatchOptions
from ..plans.pattern import Pattern


def demultiplex_stream(reads: DataFrame, patterns: Sequence[Pattern], mode: str = "single", options: MatchOptions | None = None) -> DataFrame:
    """``demultiplex`` of a streaming DataFrame of reads."""
    if not reads.isStreaming:
        raise ValueError("not a stream")
    return demultiplex(reads, patterns, mode, options)


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Matched rows appended to Parquet by pattern, once each."""
    return (
        rows.where("pattern_idx >= 0").drop(*READ).writeStream.format("parquet").partitionBy("pattern_idx")
        .option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start()
    )
