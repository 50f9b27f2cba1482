"""Sources: reads, demultiplexed rows, alignments and small side files."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.pattern import Pattern, parse_patterns


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file in any store that Spark reads; None where there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).isFile(where):
        return None
    rows = spark.read.text(path, wholetext=True).collect()  # one row, a side file
    return rows[0].value if rows else ""


def read_patterns(spark: SparkSession, patterns: str, mismatches: str) -> list[Pattern]:
    return parse_patterns(
        read_small(spark, patterns) or "", read_small(spark, mismatches) or "", lambda p: read_small(spark, p)
    )


#: Lines of a FASTQ record.
RECORD = 4


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, start, i): lines with their split, and a number that grows by one within it."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("i"),
    )


def _splits(per_split: DataFrame, *more: Column) -> DataFrame:
    """``per_split`` (file, start, n, ...) with ``before``: lines of the splits before each, by file name and place. A row a split."""
    w = Window.orderBy("file", "start")
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    return per_split.select("*", before, *more)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) with dense line numbers from 0, files by name.

    Numbers come from the place inside each split and the counts of the splits before it, so the
    lines themselves are never gathered, sorted or shuffled: one pass counts, the next one reads.
    """
    lines = _lines(spark, path)
    counts = lines.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("i").alias("first"))
    splits = _splits(counts).select("file", "start", "first", "before")
    return lines.join(F.broadcast(splits), ["file", "start"]).select((F.col("before") + F.col("i") - F.col("first")).alias("line_no"), "value")


def read_txt(spark: SparkSession, path: str) -> DataFrame:
    """(read_id, name, seq, qual): a sequence a line."""
    none = F.lit("").alias
    return numbered_lines(spark, path).select(F.col("line_no").alias("read_id"), none("name"), F.col("value").alias("seq"), none("qual"))


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: (file, start, n, head), head being the lines that may end a record of the split before."""
    found: dict[tuple[str, int], list] = {}
    for b in batches:
        for key, values in _by_split(b):
            own = found.setdefault(key, [0, []])
            own[1] += values.slice(0, max(0, RECORD - 1 - own[0])).to_pylist()
            own[0] += len(values)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int64()),
         pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.list_(pa.string()))],
        ["file", "start", "n", "head"],
    )


def _by_split(b: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """Runs of lines of one split."""
    starts, files = b.column("start"), b.column("file")
    if not b.num_rows:
        return
    new = pc.or_(pc.not_equal(starts[1:], starts[:-1]), pc.not_equal(files[1:], files[:-1])) if b.num_rows > 1 else pa.array([], pa.bool_())
    cuts = [0, *(i + 1 for i in pc.indices_nonzero(new).to_pylist()), b.num_rows]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        yield (files[lo].as_py(), starts[lo].as_py()), b.column("value").slice(lo, hi - lo)


def _records(splits: dict[tuple[str, int], tuple[int, list[str]]]):
    """Whole records: those that begin in a split, the last one with lines from the splits behind it."""

    def batch(first: int, lines: pa.Array) -> pa.RecordBatch:
        n = -(-len(lines) // RECORD)
        column = lambda k: pc.fill_null(lines.take(pa.array([i if i < len(lines) else None for i in range(k, n * RECORD, RECORD)], pa.int64())), "")
        return pa.RecordBatch.from_arrays(
            [pa.array(range(first, first + n), pa.int64()), column(0), column(1), column(3)], ["read_id", "head", "seq", "qual"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, at = None, [], 0  # lines from line number ``at`` on that aren't sent yet

        def ended() -> Iterator[pa.RecordBatch]:
            if key is not None and (rest := pa.concat_arrays(held) if held else pa.array([], pa.string())) and len(rest):
                more = splits[key][1][: -len(rest) % RECORD]
                yield batch(at // RECORD, pa.concat_arrays([rest, pa.array(more, pa.string())]))

        for b in batches:
            for k, values in _by_split(b):
                if k != key:
                    yield from ended()
                    key, before = k, splits[k][0]
                    skip = -before % RECORD  # they belong to a record that began before
                    held, at = [], before + skip
                    seen = 0
                values, seen = values.slice(max(0, skip - seen)), seen + len(values)
                held.append(values.cast(pa.string()))
                if (n := sum(map(len, held))) >= 1 << 14:
                    joint = pa.concat_arrays(held)
                    whole = n - n % RECORD
                    yield batch(at // RECORD, joint.slice(0, whole))
                    held, at = [joint.slice(whole)], at + whole
        yield from ended()

    return run


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """(read_id, name, seq, qual) of four-line records, plain or gzipped; the name ends at white space.

    ``path`` may be a folder or a pattern; its files are read by name as one, and plain ones are
    split at any byte. A first pass counts the lines of each split and keeps its first three, which
    may end a record of the split before; the second one cuts records. Nothing is shuffled; the
    driver holds a number and three lines a split.
    """
    lines = _lines(spark, path).select("value", "file", "start")
    edges = lines.mapInArrow(_edges, "file string, start long, n long, head array<string>")
    splits: dict[tuple[str, int], tuple[int, list[str]]] = {}
    before, last = 0, []
    for r in edges.orderBy("file", "start").collect():  # a row a split
        for k in last:
            splits[k][1].extend(r.head)
        last = [k for k in [*last, (r.file, r.start)] if len(splits.setdefault(k, (before, []))[1]) < RECORD - 1]
        before += r.n
    found = lines.mapInArrow(_records(splits), "read_id long, head string, seq string, qual string")
    return found.where("seq != '' or qual != ''").select("read_id", F.regexp_extract("head", r"^@?(\S*)", 1).alias("name"), "seq", "qual")


def read_pairs(spark: SparkSession, forward: str, reverse: str) -> DataFrame:
    """Two FASTQ files zipped by record number; ends with the shorter one."""
    fw = read_fastq(spark, forward)
    rv = read_fastq(spark, reverse).select("read_id", F.col("seq").alias("seq_rv"), F.col("qual").alias("qual_rv"))
    return fw.join(rv, "read_id", "inner")


def read_input(spark: SparkSession, forward: str, reverse: str | None = None) -> DataFrame:
    """Chooses the reader by the file's ending."""
    fastq = (".fastq", ".fastq.gz")
    if reverse:
        if not (forward.endswith(fastq) and reverse.endswith(fastq)):
            raise ValueError("both files of a pair must be .fastq or .fastq.gz")
        return read_pairs(spark, forward, reverse)
    if forward.endswith(fastq):
        return read_fastq(spark, forward)
    if forward.endswith(".txt"):
        return read_txt(spark, forward)
    raise ValueError(f"neither .fastq[.gz] nor .txt: {forward}")


def count_records(spark: SparkSession, path: str) -> int:
    n = spark.read.text(path).count()
    return (n + 1) // 4 if path.endswith((".fastq", ".fastq.gz")) else n


def read_demultiplexed(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Header, and (row_id, c0, c1, ...), of a table of demultiplexed rows, plain or gzipped.

    ``path`` is a file, or a folder of parts that each begin with the header, as ``write_tsv``
    leaves it. Empty fields are dropped, and then rows with another number of fields than the
    header. A header names whitelist files and lengths, so no row of barcodes equals it.
    """
    from ..operators.count import clean_rows

    first = spark.read.text(path).first()  # any file's first line: each begins with the header
    lines = numbered_lines(spark, path)
    title = first.value.removesuffix("\r") if first else ""
    header = [x for x in title.split("\t") if x]
    body = lines.where(F.regexp_replace("value", "\r$", "") != title).select(F.col("line_no").alias("row_id"), "value")
    return header, clean_rows(body, len(header))


def read_sharing(spark: SparkSession, path: str) -> DataFrame:
    """(position, retained, replaced) of lines of three fields; others are skipped, the last of equals wins."""
    f = F.split(F.trim("value"), r"\s+")
    rows = numbered_lines(spark, path).where((F.size(f) == 3) & F.get(f, F.lit(0)).rlike("^[0-9]+$")).select(
        "line_no", f[0].cast("int").alias("position"), f[1].alias("retained"), f[2].alias("replaced")
    )
    return rows.groupBy("position", "replaced").agg(F.max_by("retained", "line_no").alias("retained")).select("position", "retained", "replaced")


def _blocks(data: bytes) -> bytes:
    """The content of block-gzipped bytes, or of gzip members without block sizes."""
    out, at, view = [], 0, memoryview(data)
    while at < len(data):
        size, extra = len(data) - at, 12
        if data[at + 3] & 4:  # the block's size stands among its extra fields
            end = at + 12 + struct.unpack_from("<H", data, at + 10)[0]
            while at + extra + 4 <= end:
                n = struct.unpack_from("<H", data, at + extra + 2)[0]
                if data[at + extra : at + extra + 2] == b"BC":
                    size = struct.unpack_from("<H", data, at + extra + 4)[0] + 1
                extra += 4 + n
        d = zlib.decompressobj(31)
        out.append(d.decompress(view[at : at + size]) + d.flush())
        at += size - len(d.unused_data)
    return b"".join(out)


_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}


def _tag(data: bytes, wanted: bytes) -> str | None:
    """The value of a text tag among a record's optional fields."""
    at = 0
    while at + 3 <= len(data):
        name, kind = data[at : at + 2], chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(b"\0", at)
            if name == wanted and kind == "Z":
                return data[at:end].decode()
            at = end + 1
        elif kind == "B":
            n = struct.unpack_from("<I", data, at + 1)[0]
            at += 5 + n * _SIZES[chr(data[at])]
        else:
            at += _SIZES[kind]
    return None


def bam_records(data: bytes, tag: str) -> Iterator[tuple[str, str]]:
    """(read name, tag's value or "") of each alignment of a BAM file's bytes."""
    raw = _blocks(data) if data[:2] == b"\x1f\x8b" else data
    if raw[:4] != b"BAM\1":
        raise ValueError("not a BAM file")
    at = 8 + struct.unpack_from("<i", raw, 4)[0]
    n = struct.unpack_from("<i", raw, at)[0]
    at += 4
    for _ in range(n):
        at += 8 + struct.unpack_from("<i", raw, at)[0]
    while at + 4 <= len(raw):
        size = struct.unpack_from("<i", raw, at)[0]
        body = raw[at + 4 : at + 4 + size]
        length_name, cigar, length = body[8], struct.unpack_from("<H", body, 12)[0], struct.unpack_from("<i", body, 16)[0]
        name = body[32 : 32 + length_name - 1].decode()
        rest = 32 + length_name + 4 * cigar + (length + 1) // 2 + length
        yield name, _tag(body[rest:], tag.encode()) or ""
        at += 4 + size


def read_bam(spark: SparkSession, path: str, tag: str = "GX") -> DataFrame:
    """(ord, readname, feature) of BAM files: a file a task; ord goes by file name and then by record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for nth, data in zip(b.column("nth").to_pylist(), b.column("content"), strict=True):
                records, at = bam_records(data.as_py(), tag), 0
                while rows := list(islice(records, 1 << 16)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(range((nth << 40) + at, (nth << 40) + at + len(rows)), pa.int64()),
                         pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())],
                        ["ord", "readname", "feature"],
                    )
                    at += len(rows)

    files = spark.read.format("binaryFile").load(path)
    nth = files.select("path", (F.row_number().over(Window.orderBy("path")) - 1).cast("long").alias("nth"))  # a row a file
    named = files.select("path", "content").join(F.broadcast(nth), "path").select("nth", "content")
    return named.mapInArrow(run, "ord long, readname string, feature string")


def read_alignments(spark: SparkSession, path: str, tag: str = "GX") -> DataFrame:
    """Alignments of a BAM file, or of SAM text or a two-column table by read name."""
    if path.endswith(".bam"):
        return read_bam(spark, path, tag)
    lines = numbered_lines(spark, path).where(~F.col("value").startswith("@"))
    f = F.split("value", "\t")
    if path.endswith(".sam"):
        feature = F.regexp_extract("value", rf"\t{tag}:Z:([^\t]*)", 1)
    else:
        feature = F.coalesce(F.get(f, F.lit(1)), F.lit(""))
    return lines.select(F.col("line_no").alias("ord"), f[0].alias("readname"), feature.alias("feature"))


