"""Counting: demultiplexed rows to a cell by feature matrix with UMI collapsing."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.align import within_distance
from ..functions.seq import umi_length

@dataclass(frozen=True)
class CountConfig:
    """Which columns mean what, by place in the header, and how UMIs are collapsed."""

    feature: int
    cells: Sequence[int]
    umis: Sequence[int] | None = None
    annotations: Sequence[int] = ()
    umi_mismatches: int = 1
    hamming: bool = False
    #: Least share of a UMI's reads that a (feature, cell) needs to keep it.
    purity: float = 0.0
    #: A UMI is absorbed if it has fewer reads than this share of the other's; 0 turns the test off.
    abundance: float = 0.2
    collapse: bool = True
    cell_as_string: bool = False


@dataclass(frozen=True)
class Roles:
    feature: int
    cells: tuple[int, ...]
    umis: tuple[int, ...]
    annotations: tuple[int, ...]
    collapse: bool


@dataclass
class Dictionaries:
    """Whitelists by column, and the labels that stand for their barcodes."""

    whitelists: Mapping[int, Sequence[str]]
    feature_names: Sequence[str] | None = None
    annotation_names: Sequence[Sequence[str]] = ()
    #: (column, kept, replaced): the second takes the third's place.
    sharing: DataFrame | None = None


def resolve_roles(header: Sequence[str], config: CountConfig) -> Roles:
    """Checks the columns that the configuration names against the header."""
    for i in (config.feature, *config.cells, *config.annotations, *(config.umis or ())):
        if not 0 <= i < len(header):
            raise ValueError(f"no column {i} among {len(header)}")
    for i in (*config.cells, *config.annotations):
        if not header[i].endswith(".txt"):
            raise ValueError(f"column {i} ({header[i]}) has no whitelist")
    wanted = range(len(header)) if config.umis is None else config.umis
    umis = tuple(i for i in wanted if umi_length(header[i]) is not None)
    return Roles(config.feature, tuple(config.cells), umis, tuple(config.annotations), config.collapse and bool(umis))


def clean_rows(lines: DataFrame, n_columns: int) -> DataFrame:
    """(row_id, c0, c1, ...) of tab-separated lines (row_id, value); empty fields and misfits are dropped."""
    fields = F.filter(F.split(F.regexp_replace("value", "\r$", ""), "\t"), lambda x: x != "")
    return lines.select("row_id", fields.alias("f")).where(F.size("f") == n_columns).select(
        "row_id", *(F.col("f")[i].alias(f"c{i}") for i in range(n_columns))
    )


def share_barcodes(rows: DataFrame, sharing: DataFrame, columns: Sequence[int]) -> DataFrame:
    """Replaced barcodes become the kept ones, in the columns that ``sharing`` (position, retained, replaced) names.

    A barcode that ``sharing`` replaces twice goes to the greater one, so no row is repeated.
    """
    out = rows
    for i in columns:
        one = sharing.where(F.col("position") == i).groupBy(F.col("replaced").alias("__from")).agg(F.max("retained").alias("__to"))
        out = out.join(one, F.col(f"c{i}") == F.col("__from"), "left").withColumn(f"c{i}", F.coalesce("__to", f"c{i}")).drop("__to", "__from")
    return out


def _label(rows: DataFrame, column: str, barcodes: Sequence[str], labels: Sequence, name: str, what: str) -> DataFrame:
    """``rows`` with ``name``: the label of the barcode in ``column``; an unknown one fails the query."""
    if len(barcodes) != len(labels):
        raise ValueError(f"{len(labels)} {what} names for {len(barcodes)} barcodes")
    first = {}
    for b, x in zip(barcodes, labels, strict=True):
        first.setdefault(b, str(x))
    table = rows.sparkSession.createDataFrame(list(first.items()), "__key string, __label string")
    missing = F.raise_error(F.concat(F.lit(f"unknown {what} barcode: "), F.col(column))).cast("string")
    return (
        rows.join(table, F.col(column) == F.col("__key"), "left")
        .withColumn(name, F.coalesce("__label", missing))
        .drop("__key", "__label")
    )


def counting_rows(rows: DataFrame, roles: Roles, config: CountConfig, dictionaries: Dictionaries) -> DataFrame:
    """(row_id, umi, feature, sc_id, a0, a1, ...) of positional rows."""
    out = rows
    if dictionaries.sharing is not None:
        out = share_barcodes(out, dictionaries.sharing, range(len(rows.columns) - 1))
    cells: list[Column] = []
    for k, i in enumerate(roles.cells):
        if config.cell_as_string:
            cells.append(F.col(f"c{i}"))
            continue
        listed = dictionaries.whitelists[i]
        out = _label(out, f"c{i}", listed, range(len(listed)), f"__cell{k}", "cell")
        cells.append(F.col(f"__cell{k}"))
    feature = F.col(f"c{roles.feature}")
    if dictionaries.feature_names is not None:
        out = _label(out, f"c{roles.feature}", dictionaries.whitelists[roles.feature], dictionaries.feature_names, "__feature", "feature")
        feature = F.col("__feature")
    for k, (i, labels) in enumerate(zip(roles.annotations, dictionaries.annotation_names, strict=True)):
        out = _label(out, f"c{i}", dictionaries.whitelists[i], labels, f"a{k}", "annotation")
    return out.select(
        "row_id",
        F.concat(*(F.col(f"c{i}") for i in roles.umis)).alias("umi") if roles.umis else F.lit("").alias("umi"),
        feature.alias("feature"),
        (F.concat(*cells) if config.cell_as_string else F.concat_ws(".", *cells)).alias("sc_id"),
        *(f"a{k}" for k in range(len(roles.annotations))),
    )


def reads_per_umi(rows: DataFrame, annotations: int = 0) -> DataFrame:
    """(umi, feature, sc_id, n, a0, ...): reads of each; annotations come from the first row."""
    return rows.groupBy("umi", "feature", "sc_id").agg(
        F.count("*").alias("n"), *(F.min_by(f"a{k}", "row_id").alias(f"a{k}") for k in range(annotations)),
        F.min("row_id").alias("first"),
    )


def keep_pure(counts: DataFrame, purity: float) -> DataFrame:
    """Drops (feature, cell)s with too small a share of their UMI's reads; above 0.5 at most one stays.

    The UMI's total is aggregated before it is joined back, so a frequent UMI is no hot window.
    """
    if purity <= 0:
        return counts
    totals = counts.groupBy("umi").agg(F.sum("n").alias("__all"))
    return counts.join(totals, "umi").where(F.col("n") / F.col("__all") >= purity).drop("__all")


def _variants(umi: str, most: int) -> set[str]:
    """The UMI with up to ``most`` letters left out: near UMIs share one of these."""
    out = {umi}
    for k in range(1, min(most, len(umi)) + 1):
        for drop in combinations(range(len(umi)), k):
            out.add("".join(c for i, c in enumerate(umi) if i not in drop))
    return out


def fold(umis: Sequence[tuple[str, int]], config: CountConfig) -> list[list]:
    """First-fit fold over UMIs from the most to the least read: the earliest that accepts one absorbs it.

    Gives [UMI, its own reads, reads of all it absorbed, how many UMIs]. Acceptors are found
    through an index of shortened UMIs, so long lists aren't compared pair by pair.
    """
    reps: list[list] = []
    index: dict[str, list[int]] = {}
    for umi, n in sorted(umis, key=lambda x: (x[1], x[0]), reverse=True):
        keys = _variants(umi, config.umi_mismatches)
        taken = next(
            (
                r
                for r in sorted({r for k in keys for r in index.get(k, ())})
                if (config.abundance <= 0 or n < config.abundance * reps[r][1])
                and within_distance(reps[r][0], umi, config.umi_mismatches, config.hamming)
            ),
            None,
        )
        if taken is None:
            for k in keys:
                index.setdefault(k, []).append(len(reps))
            reps.append([umi, n, n, 1])
        else:
            reps[taken][2] += n
            reps[taken][3] += 1
    return reps


def _folded(config: CountConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("umi", pa.string()), ("own", pa.int64()), ("total", pa.int64()), ("parts", pa.int64())]))
        for b in batches:
            reps = []
            for listed in b.column("umis").to_pylist():
                got = fold([(x["umi"], x["n"]) for x in listed], config)
                reps.append([dict(zip(("umi", "own", "total", "parts"), r, strict=True)) for r in got])
            keep = [i for i, c in enumerate(b.schema.names) if c != "umis"]
            yield pa.RecordBatch.from_arrays(
                [*(b.columns[i] for i in keep), pa.array(reps, kind)], [*(b.schema.names[i] for i in keep), "reps"]
            )

    return run


def collapse(counts: DataFrame, config: CountConfig, annotations: int = 0) -> DataFrame:
    """(feature, sc_id, a0, ..., umi, n, parts): UMIs left after near ones are absorbed.

    Per (feature, cell), UMIs go from the most reads to the least (then by greatest UMI); each is
    absorbed by the earliest kept UMI within the allowed distance (and, with ``abundance``, with
    more reads by that factor), else it is kept. n is the reads of both, parts how many UMIs.
    A group's list is bounded by the number of different UMIs of its length.
    """
    names = [f"a{k}" for k in range(annotations)]
    if config.umi_mismatches <= 0:
        return counts.select("feature", "sc_id", *names, "umi", "n", F.lit(1).cast("long").alias("parts"))
    listed = counts.groupBy("feature", "sc_id").agg(
        F.collect_list(F.struct("n", "umi")).alias("umis"),
        *(F.min_by(a, "first").alias(a) for a in names),
    )
    kinds = dict(listed.dtypes)
    rest = [c for c in listed.columns if c != "umis"]
    schema = ", ".join(f"{c} {kinds[c]}" for c in rest) + ", reps array<struct<umi:string,own:bigint,total:bigint,parts:bigint>>"
    both = listed.mapInArrow(_folded(config), schema).select("feature", "sc_id", *names, F.explode("reps").alias("r"))
    return both.select("feature", "sc_id", *names, "r.umi", F.col("r.total").alias("n"), "r.parts")


@dataclass
class CountResult:
    """Tables of a counting run."""

    counts: DataFrame
    umis: DataFrame
    histogram: DataFrame
    log: DataFrame


def annotation_columns(header: Sequence[str], roles: Roles) -> list[str]:
    return [f"ANNOTATION_BC:{header[i].removesuffix('.txt')}_COL:{i}" for i in roles.annotations]


def count(rows: DataFrame, header: Sequence[str], config: CountConfig, dictionaries: Dictionaries, keep: bool = False) -> CountResult:
    """Counts of positional rows (row_id, c0, c1, ...) under ``header``.

    counts: FEATURE_ID, SC_ID, FEATURE_COUNT and annotations; umis: UMI, FEATURE_ID, SC_ID,
    annotations, UMI_COUNT (empty without collapsing); histogram: UMI_AMPLIFICATION, AB, OCCURENCE;
    log: one row of totals. Two shuffles: by UMI and then by feature and cell; repeated reads are
    added up before the first. With ``keep`` the collapsed UMIs are kept on disk, so that writing
    all tables works them out once; Spark works them out anew where an executor is lost.
    """
    roles = resolve_roles(header, config)
    k = len(roles.annotations)
    names = annotation_columns(header, roles)
    labelled = counting_rows(rows, roles, config, dictionaries)
    titled = [F.col(f"a{i}").alias(n) for i, n in enumerate(names)]
    if not roles.collapse:
        counted = labelled.groupBy("feature", "sc_id").agg(
            F.count("*").alias("n"), *(F.min_by(f"a{i}", "row_id").alias(f"a{i}") for i in range(k))
        )
        counts = counted.select(F.col("feature").alias("FEATURE_ID"), F.col("sc_id").alias("SC_ID"), F.col("n").alias("FEATURE_COUNT"), *titled)
        empty = labelled.where(F.lit(False))
        umis = empty.select(
            F.col("umi").alias("UMI"), F.col("feature").alias("FEATURE_ID"), F.col("sc_id").alias("SC_ID"), *titled, F.lit(0).cast("long").alias("UMI_COUNT")
        )
        histogram = empty.select(F.lit(0).cast("long").alias("UMI_AMPLIFICATION"), F.col("feature").alias("AB"), F.lit(0).cast("long").alias("OCCURENCE"))
        log = labelled.agg(F.count("*").alias("total_reads"), F.lit(0).cast("long").alias("removed_by_purity"), F.lit(0).cast("long").alias("umi_mismatches"))
        return CountResult(counts, umis, histogram, log)
    every = reads_per_umi(labelled, k)
    if keep:
        every = every.persist(StorageLevel.DISK_ONLY)
    pure = keep_pure(every, config.purity)
    kept = collapse(pure, config, k)
    if keep:
        kept = kept.persist(StorageLevel.DISK_ONLY)
    counts = kept.groupBy("feature", "sc_id").agg(F.count("*").alias("n"), *(F.min(f"a{i}").alias(f"a{i}") for i in range(k)))
    counts = counts.select(F.col("feature").alias("FEATURE_ID"), F.col("sc_id").alias("SC_ID"), F.col("n").alias("FEATURE_COUNT"), *titled)
    umis = kept.select(
        F.col("umi").alias("UMI"), F.col("feature").alias("FEATURE_ID"), F.col("sc_id").alias("SC_ID"), *titled, F.col("n").alias("UMI_COUNT")
    )
    histogram = kept.groupBy(F.col("n").alias("UMI_AMPLIFICATION"), F.col("feature").alias("AB")).agg(F.count("*").alias("OCCURENCE"))
    zero = F.lit(0).cast("long")
    parts = [
        every.select(F.col("n").alias("read"), zero.alias("kept"), zero.alias("absorbed")),
        pure.select(zero.alias("read"), F.col("n").alias("kept"), zero.alias("absorbed")),
        kept.select(zero.alias("read"), zero.alias("kept"), (F.col("parts") - 1).alias("absorbed")),
    ]
    total = lambda c: F.coalesce(F.sum(c), zero)
    log = reduce(DataFrame.unionByName, parts).agg(
        total("read").alias("total_reads"),
        (total("read") - total("kept")).alias("removed_by_purity"),
        total("absorbed").alias("umi_mismatches"),
    )
    return CountResult(counts, umis, histogram, log)
