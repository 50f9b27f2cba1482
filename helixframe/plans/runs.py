"""Whole runs: demultiplex, count, annotate, and the pipeline of the three."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import annotate as annotating
from ..operators import count as counting
from ..operators import demux, stats
from ..operators.matching import MatchOptions
from ..sources import files, sinks
from . import config as cfg
from .pattern import Pattern, combined, parse_barcodes, parse_list


def run_demultiplex(
    spark: SparkSession, forward: str, output: str, patterns: Sequence[Pattern], reverse: str | None = None,
    independent: bool = False, prefix: str = "", options: MatchOptions | None = None, write_stats: bool = False,
    write_failed: bool = False, combine: bool = False,
) -> DataFrame:
    """Writes the tables of a demultiplexing run below ``output``; returns the matched rows."""
    reads = files.read_input(spark, forward, reverse)
    mode = "single" if not reverse else "independent" if independent else "paired"
    rows = demux.demultiplex(reads, patterns, mode, options).persist()
    base = posixpath.join(output, f"{prefix}_" if prefix else "")
    if combine:
        joint = combined(patterns)
        sinks.write_tsv(demux.as_combined_table(rows, patterns), f"{base}{joint.name}.tsv", demux.header(joint))
    else:
        for i, p in enumerate(patterns):
            sinks.write_tsv(demux.as_table(rows, patterns, i), f"{base}{p.name}.tsv", demux.header(p))
    for i, p in enumerate(patterns):
        if p.has_dna:
            sinks.write_lines(demux.as_fastq(rows.where(F.col("pattern_idx") == i)), f"{base}{p.name}.fastq")
    if write_failed:
        sinks.write_failed(demux.failed(rows, reads.columns), f"{base}FailedLines")
    if write_stats:
        order = ["PATTERN", "POSITION", "BARCODE"]
        sinks.write_tsv(stats.edit_counts(rows, patterns).orderBy(*order), f"{base}Quality_numberMM")
        sinks.write_tsv(stats.edit_types(rows, patterns).orderBy(*order, "MISMATCH_TYPE"), f"{base}Quality_typeMM")
        if len(patterns) == 1:
            sinks.write_tsv(stats.failing_positions(rows, patterns, bool(reverse)), f"{base}Quality_failingBarcodePosition")
        sinks.write_tsv(stats.summary(rows), f"{base}summary")
    return rows


def load_dictionaries(
    spark: SparkSession, header: Sequence[str], directory: str, columns: Sequence[int], feature: int | None,
    feature_names: str | None, annotation_files: Sequence[str], sharing: str | None,
) -> counting.Dictionaries:
    """Whitelists of the named columns below ``directory``, name lists and sharing from their files."""
    lists = {
        i: parse_barcodes(files.read_small(spark, posixpath.join(directory, header[i])) or "", multi_line=True)
        for i in columns if header[i].endswith(".txt")
    }
    names = parse_list(files.read_small(spark, feature_names) or "", True, False) if feature_names else None
    labels = [parse_list(files.read_small(spark, f) or "", True, False) for f in annotation_files]
    shared = files.read_sharing(spark, sharing) if sharing else None
    return counting.Dictionaries(lists, names, labels, shared)


def write_counts(result: counting.CountResult, output: str, name: str) -> None:
    base = posixpath.join(output, "")
    sinks.write_tsv(result.counts, f"{base}COUNTDATA_{name}")
    sinks.write_tsv(result.umis, f"{base}UMIDATA_{name}")
    sinks.write_tsv(result.histogram, f"{base}UMISTAT{name}")
    sinks.write_tsv(result.log, f"{base}LOG{name}")


def run_count(
    spark: SparkSession, path: str, output: str, directory: str, config: counting.CountConfig,
    feature_names: str | None = None, annotation_files: Sequence[str] = (), sharing: str | None = None, name: str = "counts",
) -> counting.CountResult:
    header, rows = files.read_demultiplexed(spark, path)
    columns = {*config.cells, *config.annotations, config.feature}
    dictionaries = load_dictionaries(spark, header, directory, sorted(columns), config.feature, feature_names, annotation_files, sharing)
    result = counting.count(rows, header, config, dictionaries, keep=True)
    write_counts(result, output, name)
    return result


def run_annotate(spark: SparkSession, path: str, alignments: str, tag: str = "GX") -> DataFrame:
    """Writes ``path`` with a FEATURE column beside it; rows without a feature are left out."""
    header, rows = files.read_demultiplexed(spark, path)
    out = annotating.annotate(rows, files.read_alignments(spark, alignments, tag)).drop("row_id")
    sinks.write_tsv(out, f"{path.removesuffix('.tsv')}_annotated.tsv", [*header, "FEATURE"])
    return out


def run_pipeline(spark: SparkSession, config: cfg.PipelineConfig) -> counting.CountResult:
    """Reads to counts without files between the steps; the DNA aligner's output is an input."""
    patterns = files.read_patterns(spark, config.pattern, config.mismatches)
    cfg.check_same_shape(patterns)
    first = patterns[0]
    rows = run_demultiplex(
        spark, config.forward, config.output, patterns, config.reverse, config.independent, config.prefix,
        MatchOptions(hamming=config.hamming), config.write_stats, config.write_failed, combine=True,
    )
    joint = combined(patterns)
    table = demux.as_combined_table(rows, patterns)
    header = demux.header(joint)
    column = lambda i: cfg.table_column(first, i)
    if first.has_dna:
        if not config.alignments:
            raise ValueError("a pattern with [DNA] needs the alignments of its reads")
        table = annotating.annotate(table, files.read_alignments(spark, config.alignments, config.tag))
        table = table.withColumnRenamed("feature", f"c{len(header)}")
        header, feature = [*header, "FEATURE"], len(header)
    else:
        feature = column(config.feature)
    by_name = {e.name: e.barcodes for e in joint.elements if e.emitted}
    cells, annotations = [column(i) for i in config.cells], [column(i) for i in config.annotations]
    lists = {i: by_name[header[i]] for i in {*cells, *annotations, feature} if header[i].endswith(".txt")}
    names = parse_list(files.read_small(spark, config.feature_names) or "", True, False) if config.feature_names and not first.has_dna else None
    labels = [parse_list(files.read_small(spark, f) or "", True, False) for f in config.annotation_names]
    shared = files.read_sharing(spark, config.sharing) if config.sharing else None
    umi = None if config.umi is None else [column(config.umi)]
    counted = counting.CountConfig(
        feature, cells, umi, annotations, first.elements[config.umi].max_edits if config.umi is not None else 1,
        config.hamming, config.purity, config.abundance, config.collapse, config.cell_as_string,
    )
    table = table.select(F.split("c0", "_")[0].cast("long").alias("row_id"), *table.columns)
    result = counting.count(table, header, counted, counting.Dictionaries(lists, names, labels, shared), keep=True)
    write_counts(result, config.output, config.prefix or "output")
    return result


def main(argv: Sequence[str]) -> None:
    """``python -m helixframe demultiplex|count|annotate|pipeline ...``"""
    spark = SparkSession.builder.appName("helixframe").getOrCreate()
    tool, rest = argv[0], list(argv[1:])
    if tool == "demultiplex":
        a = cfg.demultiplex_parser().parse_args(rest)
        run_demultiplex(
            spark, a.input, a.output, files.read_patterns(spark, a.patterns, a.mismatches), a.reverse, a.independent,
            a.prefix, MatchOptions(a.hamming, a.precalculate_indels), a.stats, a.failed, a.combine,
        )
        sinks.write_parameters(spark, vars(a), posixpath.join(a.output, f"{a.prefix}_parameter.ini" if a.prefix else "parameter.ini"))
    elif tool == "count":
        a = cfg.count_parser().parse_args(rest)
        config = counting.CountConfig(
            a.feature, cfg.integers(a.cells), cfg.integers(a.umis) or None, cfg.integers(a.annotations), a.umi_mismatches,
            a.hamming, a.purity, a.abundance, a.collapse, a.cell_as_string,
        )
        run_count(spark, a.input, a.output, a.barcode_dir, config, a.feature_names, a.annotation_files.replace(",", " ").split(), a.sharing)
    elif tool == "annotate":
        a = cfg.annotate_parser().parse_args(rest)
        run_annotate(spark, a.input, a.alignments, a.tag)
    elif tool == "pipeline":
        a = cfg.pipeline_parser().parse_args(rest)
        config = cfg.PipelineConfig.from_ini(files.read_small(spark, a.config) or "")
        config.alignments = a.alignments
        run_pipeline(spark, config)
    else:
        raise SystemExit(f"unknown tool {tool}: demultiplex, count, annotate or pipeline")
