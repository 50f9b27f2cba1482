"""Sources, sinks, whole runs and streaming, over files."""

import gzip
import struct

import pytest

from helixframe.operators import demux, stats
from helixframe.plans import config as cfg
from helixframe.plans import runs
from helixframe.plans.pattern import parse_patterns
from helixframe.sources import files
from helixframe.streaming.demux import demultiplex_stream, write_stream

READS = [("r1 x", "ACGTAAAATTTT"), ("r2", "CCCCAAATTTTT"), ("r3", "GGGGGGGGGGGG"), ("r3", "ACGTAAAACCTT")]


def fastq(path, reads, suffix=""):
    text = "".join(f"@{n}\n{s}\n+\n{'I' * len(s)}\n" for n, s in reads)
    path.write_bytes(gzip.compress(text.encode()) if str(path).endswith(".gz") else text.encode())
    return str(path)


def setup(tmp_path):
    (tmp_path / "bc.txt").write_text("ACGT,CCCC")
    (tmp_path / "p.txt").write_text(f"P:[{tmp_path}/bc.txt][AAAA][4X]\n")
    (tmp_path / "m.txt").write_text("1,1,0\n")
    return str(tmp_path / "p.txt"), str(tmp_path / "m.txt")


def test_fastq_plain_and_gzipped(spark, tmp_path):
    for name in ("a.fastq", "a.fastq.gz"):
        path = fastq(tmp_path / name, READS)
        got = sorted(tuple(r) for r in files.read_input(spark, path).select("read_id", "name", "seq", "qual").collect())
        assert got == [(i, n.split()[0], s, "I" * len(s)) for i, (n, s) in enumerate(READS)]
        assert files.count_records(spark, path) == 4


def test_pairs_end_with_the_shorter_file(spark, tmp_path):
    a, b = fastq(tmp_path / "a.fastq", READS), fastq(tmp_path / "b.fastq", READS[:2])
    assert sorted(r.seq_rv for r in files.read_input(spark, a, b).collect()) == sorted(s for _, s in READS[:2])
    with pytest.raises(ValueError, match="pair"):
        files.read_input(spark, a, "b.txt")
    with pytest.raises(ValueError, match="neither"):
        files.read_input(spark, "a.csv")


def test_txt_and_sharing(spark, tmp_path):
    (tmp_path / "a.txt").write_text("ACGT\nCC")
    assert [r.seq for r in files.read_input(spark, str(tmp_path / "a.txt")).orderBy("read_id").collect()] == ["ACGT", "CC"]
    (tmp_path / "s.tsv").write_text("0 A B\nbad\n0\tC B\n1 X Y")
    got = sorted(tuple(r) for r in files.read_sharing(spark, str(tmp_path / "s.tsv")).collect())
    assert got == [(0, "C", "B"), (1, "X", "Y")]


def bam(records):
    head = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 0)
    out = head
    for name, tags in records:
        n = name.encode() + b"\0"
        body = struct.pack("<iiBBHHHiiii", -1, -1, len(n), 0, 0, 0, 4, 3, -1, -1, 0) + n + b"\0\0" + b"\0\0\0" + tags
        out += struct.pack("<i", len(body)) + body
    return out


def test_bam_and_sam(spark, tmp_path):
    raw = bam([("r1", b"NHC\1GXZG1\0"), ("r2", b"GXi\0\0\0\0"), ("r1", b"GXZG9\0"), ("r3", b"BCBs\2\0\0\0\1\0\2\0GXZ-\0")])
    (tmp_path / "a.bam").write_bytes(gzip.compress(raw[:50]) + gzip.compress(raw[50:]))
    got = [(r.readname, r.feature) for r in files.read_alignments(spark, str(tmp_path / "a.bam")).orderBy("ord").collect()]
    assert got == [("r1", "G1"), ("r2", ""), ("r1", "G9"), ("r3", "-")]
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nr1\t0\tNH:i:1\tGX:Z:G1\nr2\t4\n")
    got = [(r.readname, r.feature) for r in files.read_alignments(spark, str(tmp_path / "a.sam")).orderBy("ord").collect()]
    assert got == [("r1", "G1"), ("r2", "")]


def test_ini():
    text = "forward=a # note\nOUTPUT=o\nPATTERN=p\nMISMATCHES=m\nSC_ID=0,1\nFEATURE_ID=2\nHAMMING=yes\nPREFIX=\n"
    c = cfg.PipelineConfig.from_ini(text)
    assert (c.forward, c.cells, c.hamming, c.prefix, c.write_stats) == ("a", [0, 1], True, "", True)
    with pytest.raises(ValueError, match="missing"):
        cfg.parse_ini("FORWARD=a")
    with pytest.warns(UserWarning, match="NEW"):
        cfg.parse_ini(text + "new=1")


def test_pipeline_from_files_to_counts(spark, tmp_path):
    p, m = setup(tmp_path)
    out = tmp_path / "out"
    fastq(tmp_path / "a.fastq", READS)
    c = cfg.PipelineConfig(str(tmp_path / "a.fastq"), str(out), p, m, [0], 0, umi=2, prefix="t")
    got = sorted(tuple(r) for r in runs.run_pipeline(spark, c).counts.collect())
    assert got == [("ACGT", "0", 2), ("CCCC", "1", 1)]
    text = "".join(x.read_text() for x in (out / "t_P.tsv").glob("part*"))
    assert "READNAME\tbc.txt\tAAAA\t4X" in text and "0_r1\tACGT\tAAAA\tTTTT" in text
    assert "GGGGGGGGGGGG" in "".join(x.read_text() for x in (out / "t_FailedLines").glob("part*"))
    header, rows = files.read_demultiplexed(spark, str(out / "t_P.tsv"))
    assert header[0] == "READNAME" and len(header) == 4 and rows.count() >= 1


def test_annotate_run(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("READNAME\tX.txt\nr1\tA\nr2\tC\nr3\tG\n")
    (tmp_path / "a.sam").write_text("r1\t0\tGX:Z:G1\nr1\t0\tGX:Z:G2\nr2\t0\tGX:Z:-\n")
    got = [tuple(r) for r in runs.run_annotate(spark, str(tmp_path / "d.tsv"), str(tmp_path / "a.sam")).collect()]
    assert got == [("r1", "A", "G1")]


def test_statistics(spark, tmp_path):
    (tmp_path / "bc.txt").write_text("ACGT,CCCC")
    ps = parse_patterns("P:[bc][AAAA][4X]", "1,1,0", lambda _: "ACGT,CCCC")
    reads = spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(READS)], "read_id long, name string, seq string")
    rows = demux.demultiplex(reads, ps)
    counts = {(r.POSITION, r.BARCODE): (r["0MM"], r["1MM"]) for r in stats.edit_counts(rows, ps).collect()}
    assert counts == {(0, "ACGT"): ("2", "0"), (0, "CCCC"): ("1", "0"), (1, "AAAA"): ("2", "1")}
    kinds = {(r.BARCODE, r.MISMATCH_TYPE): r.COUNT for r in stats.edit_types(rows, ps).collect()}
    assert kinds["AAAA", "DELETION"] == 1 and sum(kinds.values()) == 1
    fails = {r.POSITION: r.COUNT for r in stats.failing_positions(rows, ps).collect()}
    assert fails == {0: 1, 1: 0, 2: 0}
    assert tuple(stats.summary(rows).first())[:4] == (4, 2, 1, 1)


def test_stream_gives_what_a_batch_gives(spark, tmp_path):
    ps = parse_patterns("P:[bc][AAAA][4X]", "1,1,0", lambda _: "ACGT,CCCC")
    reads = spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(READS)], "read_id long, name string, seq string")
    reads.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(reads.schema).parquet(str(tmp_path / "in"))
    q = write_stream(demultiplex_stream(stream, ps), str(tmp_path / "out"), str(tmp_path / "check"))
    q.processAllAvailable()
    q.stop()
    got = sorted((r.read_id, r.barcodes) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted((r.read_id, r.barcodes) for r in demux.matched(demux.demultiplex(reads, ps)).collect())


def test_fastq_in_splits_of_any_place(spark, tmp_path):
    """Records are whole wherever splits begin, qualities may begin with @ or +, and the last line end may lack."""
    reads = [(f"r{i} x", "ACGT"[i % 4] * (1 + i % 9), "@+I"[i % 3] * (1 + i % 9)) for i in range(200)]
    text = "".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in reads)
    (tmp_path / "a.fastq").write_text(text[: text.index("@r90")])
    (tmp_path / "b.fastq").write_text(text[text.index("@r90") : -1])
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("7", "64", "501", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            if size == "7":  # splits of less than a record, over the first file's beginning
                (tmp_path / "c.fastq").write_text(text[: text.index("@r9 ")])
                got = sorted(tuple(r) for r in files.read_fastq(spark, str(tmp_path / "c.fastq")).collect())
                assert got == [(i, f"r{i}", s, q) for i, (_, s, q) in enumerate(reads[:9])]
                continue
            df = files.read_fastq(spark, str(tmp_path / "[ab].fastq"))
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
            assert sorted(tuple(r) for r in df.collect()) == [(i, f"r{i}", s, q) for i, (_, s, q) in enumerate(reads)]
            assert [r.line_no for r in files.numbered_lines(spark, str(tmp_path / "[ab].fastq")).orderBy("line_no").collect()] == list(range(800))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_count_reads_what_demultiplex_wrote_in_parts(spark, tmp_path):
    p, m = setup(tmp_path)
    reads = [(i, f"r{i}", s) for i, (_, s) in enumerate(READS * 5)]
    ps = files.read_patterns(spark, p, m)
    rows = demux.demultiplex(spark.createDataFrame(reads, "read_id long, name string, seq string").repartition(4), ps)
    out = str(tmp_path / "t.tsv")
    from helixframe.sources import sinks

    sinks.write_tsv(demux.as_table(rows, ps, 0), out, demux.header(ps[0]))
    header, back = files.read_demultiplexed(spark, out)
    assert header == ["READNAME", "bc.txt", "AAAA", "4X"]
    assert sorted(r.c0 for r in back.collect()) == sorted(r.c0 for r in demux.as_table(rows, ps, 0).collect()) and back.count() == 15
    got = runs.run_count(spark, out, str(tmp_path / "counts"), str(tmp_path), counting(), name="x")
    assert sorted((r.FEATURE_ID, r.SC_ID, r.FEATURE_COUNT) for r in got.counts.collect()) == [("ACGT", "0", 2), ("CCCC", "1", 1)]


def counting():
    from helixframe.operators.count import CountConfig

    return CountConfig(1, [1], [3], abundance=0.0, umi_mismatches=0)
