"""Interval joins, read classes, island tables, sources, runs and streams."""

import gzip
import json
import math
import struct

import numpy as np
import pytest
from islet.operators import cohort, intervals, qc, ranks, views, xci
from islet.plans import cli, runs
from islet.sources import bam, tables
from islet.sources.bam_write import ALIGNED, write_reads
from islet.streaming.incremental import CohortStates, append_counts, counts_stream
from pyspark.sql import functions as F


def test_spans(spark):
    islands = spark.createDataFrame([("c", 100, 200)], "chrom string, start long, end long")
    reads = spark.createDataFrame([(i, "c", a, b) for i, (a, b) in enumerate([(100, 200), (101, 200), (100, 199), (50, 300)])] + [(9, "d", 0, 999)], "i int, chrom string, ref_start long, ref_end long")
    for size in (None, 1, 7, 64, 1000):
        assert sorted(r.i for r in intervals.span_join(reads, islands, bin_size=size).collect()) == [0, 3]


def test_genome_axis(spark):
    got = {r.chrom: r for r in intervals.chrom_table(spark).collect()}
    assert got["chr3"].chrom_offset == 491_149_951 and got["chrX"].chrom_offset == 2_875_001_522 and got["chrY"].band_end == 3_088_269_832
    at = spark.createDataFrame([("chr2", 10, 21), ("chrM", 1, 2)], "chrom string, start long, end long")
    assert [r.x_pos for r in intervals.genome_positions(at, intervals.chrom_table(spark)).collect()] == [248_956_422 + 15]


def test_par(spark):
    df = spark.createDataFrame([(60_000, 60_001), (60_000, 60_002), (2_699_520, 2_699_600), (2_699_519, 2_699_600)], "start long, end long")
    outside, inside = intervals.split_par(df)
    assert sorted(r.start for r in inside.collect()) == [60_000, 2_699_519] and outside.count() == 2


def test_binned_rank(spark):
    df = spark.createDataFrame([(v, f"k{i}") for i, v in enumerate([0.5, 0.1, 0.1, None, 0.9, 0.50001])], "v double, k string")
    got = {r.k: r["rank"] for r in intervals.binned_rank(df, "v", "k").collect()}
    assert [got[f"k{i}"] for i in (3, 1, 2, 0, 5, 4)] in ([5, 0, 1, 2, 3, 4],)


def test_classes(spark):
    df = spark.createDataFrame([(9, 12), (3, 12), (6, 12), (0, 0)], "m int, n int")
    assert [r.c for r in df.select(xci.classify_read(F.col("m"), F.col("n")).alias("c")).collect()] == ["methylated", "unmethylated", "partial", None]


def test_colours(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.25, 0.5, 0.9, -0.25, -0.5)], "d double")
    assert [r.c for r in df.select(xci.delta_rgb(F.col("d")).alias("c")).collect()] == ["210,210,210", "110,145,205", "10,80,200", "10,80,200", "205,130,110", "200,50,10"]


def test_sex(spark):
    df = spark.createDataFrame([("a", "chrX", 90), ("a", "chrY", 11), ("b", "chrX", 5), ("c", "chr1", 7)], "sample string, contig string, mapped long")
    assert {r.sample: r.sex for r in xci.sex_of(df).collect()} == {"a": "M", "b": "F", "c": "unknown"}


def test_kde(spark):
    got = {round(r.x): r.density for r in xci.kde(spark.createDataFrame([(10.0,), (20.0,), (40.0,)], "pct double"), points=101).collect()}
    assert (got[0], got[20], got[50]) == (pytest.approx(0.01069769, abs=1e-8), pytest.approx(0.02148954, abs=1e-8), pytest.approx(0.00837372, abs=1e-8))
    assert xci.kde(spark.createDataFrame([(1.0,)], "pct double")).count() == 0


def test_mixture(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(20, 4, 300), rng.normal(80, 6, 100)])
    fit = xci.gaussian_mixture(spark.createDataFrame([(float(v),) for v in x], "pct double"), rounds=40)
    assert fit["mean_low"] == pytest.approx(20, abs=1) and fit["mean_high"] == pytest.approx(80, abs=2) and fit["weight_low"] == pytest.approx(0.75, abs=0.02)
    assert xci.gaussian_mixture(spark.createDataFrame([(1.0,)] * 9, "pct double")) is None


def test_histogram_and_limits(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 9.99, 10.0, 100.0, 101.0, None)], "v double")
    assert {r.bin: r.n for r in views.histogram(df, "v", low=0.0, high=100.0, bins=10).collect()} == {1: 2, 2: 1, 10: 1}
    near = views.box_summary(df.selectExpr("1 AS k", "v"), ["k"], "v", accuracy=1000).first()
    assert (near.n, near.low, near.median, near.high) == (5, 0.0, 10.0, 101.0)
    assert views.color_limit(df.limit(0), "v").first().cmax == 1.0 and views.spread_limit(df.limit(1), "v").first().cmax == 3.0


def test_text_sources(spark, tmp_path):
    (tmp_path / "x.txt").write_text("S1  # low_coverage\n# S2\n\n  S3\nS1\n")
    assert sorted(r.sample for r in tables.read_exclude_list(spark, str(tmp_path / "x.txt")).collect()) == ["S1", "S3"]
    (tmp_path / "i.tsv").write_text("Chrom\tchromStart\tCHROMEND\tcpgNum\tname\nchr1\t10\t20\t5\tnan\nchr2\t1\t2\t3\tgene\n")
    assert [tuple(r) for r in tables.read_island_tsv(spark, str(tmp_path / "i.tsv")).orderBy("chrom").collect()] == [("chr1", 10, 20, 5, None, "chr1:10-20"), ("chr2", 1, 2, 3, "gene", "chr2:1-2")]
    (tmp_path / "i.bed").write_text("# c\nchrX\t1\t9\t\nchrX\t20\t30\tCpG\textra\nchrY\t1\t2\n")
    assert [tuple(r) for r in tables.read_island_bed(spark, str(tmp_path / "i.bed")).orderBy("start").collect()] == [("chrX", 1, 9, "chrX:1-9"), ("chrX", 20, 30, "CpG")]
    (tmp_path / "bad.tsv").write_text("chrom\tx\nchr1\t1\n")
    with pytest.raises(ValueError, match="chromstart"):
        tables.read_island_tsv(spark, str(tmp_path / "bad.tsv"))


def aligned(name, flag, pos, cigar, seq, mm="", ml=(), hp=None):
    codes = {b: i for i, b in enumerate("=ACMGRSVTWYHKDBN")}
    packed = bytes(codes[a] << 4 | codes[b] for a, b in zip(seq[::2], (seq + "=")[1::2]))
    more = b"MMZ" + mm.encode() + b"\0" + b"MLBC" + struct.pack("<I", len(ml)) + bytes(ml) if mm else b""
    more += b"HPC" + bytes([hp]) if hp is not None else b""
    body = struct.pack("<iiBBHHHiiii", 0, pos, len(name) + 1, 60, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0"
    body += b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(op)) for n, op in cigar) + packed + b"\xff" * len(seq) + more
    return struct.pack("<i", len(body)) + body


def write_bam(path, rows):
    head = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chrX\0" + struct.pack("<i", 1000)
    path.write_bytes(gzip.compress(head) + gzip.compress(b"".join(rows)))


def test_alignments(spark, tmp_path):
    rows = [
        aligned("r1", 0, 100, [(2, "S"), (6, "M")], "ACCGCGAC", "C+m?,1,0,0;", (200, 10, 255), 1),
        aligned("r2", 16, 100, [(4, "M"), (2, "I"), (2, "D"), (4, "M")], "CGGTGGACGA", "C+hm,0,1;", (1, 250, 2, 3), 2),
        aligned("r3", 1024, 90, [(50, "M")], "A" * 50),
    ]
    write_bam(tmp_path / "one.x.bam", rows)
    got = {r.read_id: r for r in cli.bam(spark, str(tmp_path / "*.bam")).collect()}
    assert (got["r1"].sample, got["r1"].chrom, got["r1"].ref_start, got["r1"].ref_end, got["r1"].hp) == ("one", "chrX", 100, 106, 1)
    # the second, third and fourth C, past a clip of two
    assert [(c.rpos, c.prob) for c in got["r1"].calls] == [(100, 200), (102, 10), (105, 255)]
    assert got["r2"].ref_end == 110 and got["r3"].is_duplicate and got["r3"].calls == []
    # on the reverse strand the read's G are C counted from its end: the insertion's calls have no place
    assert [(c.rpos, c.prob) for c in got["r2"].calls] == [(108, 250)]
    with pytest.raises(ValueError):
        (tmp_path / "bad").write_bytes(gzip.compress(b"nope" * 9))
        list(bam.records(str(tmp_path / "bad")))


def blocked(data):
    """One block of a blocked file."""
    import zlib

    squeezed = zlib.compressobj(wbits=-15)
    body = squeezed.compress(data) + squeezed.flush()
    return struct.pack("<BBBBIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def write_indexed(path, contigs, reads):
    """contigs: names; reads: (contig number, position, bytes) in order, then unplaced ones. A block every few reads."""
    head = b"BAM\1" + struct.pack("<ii", 0, len(contigs)) + b"".join(struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", 1 << 20) for c in contigs)
    out, places = blocked(head), []
    for k in range(0, len(reads), 3):
        at = 0
        for _, _, data in reads[k : k + 3]:
            places.append(len(out) << 16 | at)
            at += len(data)
        out += blocked(b"".join(d for *_, d in reads[k : k + 3]))
    end = len(out) << 16
    path.write_bytes(out + blocked(b""))
    index = b"BAI\1" + struct.pack("<i", len(contigs))
    for c in range(len(contigs)):
        mine = [i for i, r in enumerate(reads) if r[0] == c]
        if not mine:
            index += struct.pack("<ii", 0, 0)
            continue
        last = places[mine[-1] + 1] if mine[-1] + 1 < len(reads) else end
        index += struct.pack("<iIiQQ", 2, 0, 1, places[mine[0]], last) + struct.pack("<IiQQQQ", 37450, 2, places[mine[0]], last, len(mine), 0)
        windows = (reads[mine[-1]][1] >> 14) + 1
        first = [next(places[i] for i in mine if reads[i][1] + 50 > w << 14) for w in range(windows)]
        index += struct.pack(f"<i{windows}Q", windows, *first)
    (path.parent / (path.name + ".bai")).write_bytes(index)


def test_indexed_alignments(spark, tmp_path, monkeypatch):
    placed = sorted((c, int(p)) for c in (0, 2) for p in np.random.default_rng(c).integers(0, 90_000, 40))
    at = 36 - 32  # the contig's number follows the record's size
    reads = []
    for i, (c, p) in enumerate(placed):
        data = aligned(f"r{i}", 0, p, [(50, "M")], "A" * 50)
        reads.append((c, p, data[:at] + struct.pack("<i", c) + data[at + 4 :]))
    none = aligned("u", 4, -1, [], "ACGT")
    reads.append((-1, -1, none[:at] + struct.pack("<i", -1) + none[at + 4 :]))
    write_indexed(tmp_path / "s.bam", ["chr1", "chr2", "chrX"], reads)
    monkeypatch.setattr(bam, "SPLIT", 200)
    assert len(bam.parts(str(tmp_path / "s.bam"), None)) > 6
    whole = [(r[0], r[1], r[2]) for p in bam.parts(str(tmp_path / "s.bam"), None) for r in bam.records(p.path, p.chunks)]
    assert sorted(whole, key=str) == sorted([(f"r{i}", ("chr1", None, "chrX")[c], p) for i, (c, p) in enumerate(placed)] + [("u", None, -1)], key=str)
    path = str(tmp_path / "*.bam")
    assert cli.bam(spark, path).count() == 81 and cli.bam(spark, path).where("is_unmapped").count() == 1
    assert {r.contig: r.mapped for r in cli.bam(spark, path, table="contigs").collect()} == {"chr1": 40, "chr2": 0, "chrX": 40}
    for span in ((0, 1 << 60), (20_000, 50_000), (40_000, 40_001), (89_999, 10**6)):
        got = {r.read_id for r in cli.bam(spark, path, region=f"chrX:{span[0]}-{span[1]}").collect()}
        assert got == {f"r{i}" for i, (c, p) in enumerate(placed) if c == 2 and p < span[1] and p + 50 > span[0]}
    assert cli.bam(spark, path, region="chr2").count() == 0
    with pytest.warns(UserWarning, match="no index"):
        bam.parts(str(tmp_path / "other.bam"), None)
    with pytest.raises(Exception, match="no alignment files"):
        cli.bam(spark, str(tmp_path / "none*.bam")).count()


def binned_index(path, contigs, reads, width=50):
    """An index with the smallest bin of each read, and chunks of each bin's runs of reads; the file is that of ``write_indexed``."""
    write_indexed(path, contigs, reads)
    f = bam.Blocks(str(path))
    bam.contig_names(f)
    places = []
    for _, _, data in reads:
        places.append(f.offset())
        f.read(len(data))
    places.append(f.offset())

    def bin_of(a, b):
        for first, bits in reversed(bam._LEVELS):
            if a >> bits == b - 1 >> bits:
                return first + (a >> bits)

    index = b"BAI\1" + struct.pack("<i", len(contigs))
    for c in range(len(contigs)):
        bins, mine = {}, [i for i, r in enumerate(reads) if r[0] == c]
        for i in mine:
            bins.setdefault(bin_of(reads[i][1], reads[i][1] + width), []).append((places[i], places[i + 1]))
        merged = {}
        for b, spans in bins.items():
            out = []
            for x, y in spans:
                if out and out[-1][1] == x:
                    out[-1] = (out[-1][0], y)
                else:
                    out.append((x, y))
            merged[b] = out
        index += struct.pack("<i", len(merged) + 1)
        for b, spans in merged.items():
            index += struct.pack("<Ii", b, len(spans)) + b"".join(struct.pack("<QQ", *x) for x in spans)
        index += struct.pack("<IiQQQQ", 37450, 2, 0, 0, len(mine), 0)
        windows = (max((reads[i][1] + width - 1 for i in mine), default=-1) >> 14) + 1
        first = [next((places[i] for i in mine if reads[i][1] + width > w << 14), 0) for w in range(windows)]
        index += struct.pack(f"<i{windows}Q", windows, *first)
    (path.parent / (path.name + ".bai")).write_bytes(index)


def test_index_lookup(spark, tmp_path):
    """Only chunks that can hold reads of the regions are read: bytes fall with the region, and no read is missed or told twice."""
    rng, at = np.random.default_rng(4), 4
    placed = sorted((int(c), int(p)) for c in range(2) for p in rng.integers(0, 8_000_000, 3000))
    reads = []
    for i, (c, p) in enumerate(placed):
        data = aligned(f"r{i}", 0, p, [(50, "M")], "A" * 50)
        reads.append((c, p, data[:at] + struct.pack("<i", c) + data[at + 4 :]))
    binned_index(tmp_path / "s.bam", ["chr1", "chrX"], reads)
    path, whole = str(tmp_path / "s.bam"), (tmp_path / "s.bam").stat().st_size

    def fetched(parts):
        total = 0
        for p in parts:
            for a, b in p.chunks:
                f = bam.Blocks(path, a)
                while b is not None and f.offset() < b:
                    f.read(1)
                    f.at = len(f.data)
                total += f.fetched
        return total

    sizes = []
    for spans in ([("chrX", 0, 1 << 40)], [("chrX", 1_000_000, 3_000_000)], [("chrX", 1_000_000, 1_010_000)], [("chrX", 7_999_990, 8_000_000)], [("chr1", k * 900_000, k * 900_000 + 100) for k in range(8)], [("chrM", 0, 9)]):
        regions = bam.Regions(spans)
        parts = bam.parts(path, regions)
        got = [r[0] for p in parts for r in bam.records(path, p.chunks) if regions.meet(r[1], r[2], r[3])]
        want = [f"r{i}" for i, (c, p) in enumerate(placed) if any(("chr1", "chrX")[c] == n and p < b and p + 50 > a for n, a, b in spans)]
        assert sorted(got) == sorted(want)
        sizes.append(fetched(parts))
    assert sizes[0] < 0.6 * whole and sizes[1] < 0.3 * sizes[0] < whole and sizes[2] < 0.03 * whole and sizes[4] < 0.1 * whole and sizes[5] == 0
    option = bam.regions_text([("chr1", 5, 9), ("chr1", 12_000, 12_100), ("chr1", 900_000, 900_100), ("chrX", 0, 7)])
    assert option == "chr1:5-12100\tchr1:900000-900100\tchrX:0-7"
    assert bam.regions_of("HLA:01:5-9\tchr7\t2").by == {"HLA:01": [(5, 9)], "chr7": [(0, 1 << 60)], "2": [(0, 1 << 60)]}
    assert cli.bam(spark, path, region=option).count() == sum(1 for c, p in placed if any(c == k and p < b and p + 50 > a for k, a, b in ((0, 5, 12_100), (0, 900_000, 900_100), (1, 0, 7))))
    assert cli.bam(spark, f"file://{tmp_path}/*.bam", region="chrX:1000000-1010000").count() == sum(c == 1 and p < 1_010_000 and p + 50 > 1_000_000 for c, p in placed)


def test_filters_reach_the_index(spark, tmp_path, monkeypatch):
    """Filters on a read's place narrow the chunks that a scan reads, and don't change what it gives."""
    at, reads = 4, []
    for i in range(400):
        data = aligned(f"r{i}", 0, i * 20_000, [(50, "M")], "A" * 50)
        reads.append((0, i * 20_000, data[:at] + struct.pack("<i", 0) + data[at + 4 :]))
    binned_index(tmp_path / "s.bam", ["chrX"], reads)
    binned_index(tmp_path / "t.bam", ["chrX"], reads)
    reader = bam.PushedReader({"path": str(tmp_path / "*.bam")})
    every = sum(b - a for p in reader.partitions() for a, b in p.chunks if b)
    from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan

    kept = list(reader.pushFilters([EqualTo(("chrom",), "chrX"), LessThan(("ref_start",), 1_000_000), GreaterThan(("ref_end",), 900_000), EqualTo(("sample",), "t")]))
    assert len(kept) == 4 and {p.path[-5:] for p in reader.partitions()} == {"t.bam"}
    assert 0 < sum(b - a for p in reader.partitions() for a, b in p.chunks) < every / 10
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        load = lambda: cli.bam(spark, str(tmp_path / "*.bam"), pushdown="true")
        got = load().where("chrom = 'chrX' AND ref_start < 1000000 AND ref_end > 900000 AND sample = 't'")
        assert sorted(r.ref_start for r in got.collect()) == [p for _, p, _ in reads if p < 1_000_000 and p + 50 > 900_000]
        assert load().where("chrom = 'chr9'").count() == 0 and load().where("ref_start >= 0 OR chrom = 'x'").count() == 800
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_count_from_files(spark, tmp_path):
    """The command from alignment files to counts: only the islands' chunks are read, and a second run makes nothing."""
    at, reads = 4, []
    for i in range(60):
        data = aligned(f"r{i}", 0, i * 50_000, [(60, "M")], "CG" * 30, "C+m,0,0,0;", (200, 10, 255), 1 + i % 2)
        reads.append((0, i * 50_000, data[:at] + struct.pack("<i", 0) + data[at + 4 :]))
    binned_index(tmp_path / "a.bam", ["chr1"], reads, width=60)
    binned_index(tmp_path / "none.bam", ["chr1"], reads[1:2], width=60)
    (tmp_path / "i.tsv").write_text("chrom\tchromStart\tchromEnd\tcpgNum\tname\nchr1\t0\t20\t5\tfirst\nchr1\t500010\t500050\t3\tten\nchr1\t70000\t70010\t3\tempty\n")
    run = lambda out, *more: cli.main(["count", "--bam_glob", str(tmp_path / "*.bam"), "--cpg_tsv", str(tmp_path / "i.tsv"), "--outdir", str(tmp_path / "o"), *more], spark)
    run("o")
    rows = {(r.sample, r.island_name, r.haplotype): (r.n_reads, r.n_cpg_total, r.n_cpg_meth) for r in tables.read_counts(spark, str(tmp_path / "o/all_samples_counts")).collect()}
    assert rows == {("a", "first", "hap1"): (1, 3, 2), ("a", "first", "all"): (1, 3, 2)}
    folders = lambda: sorted(p.name for p in (tmp_path / "o/store/counts").iterdir())
    before = folders()
    run("o")
    assert folders() == before
    (tmp_path / "i.tsv").write_text((tmp_path / "i.tsv").read_text().replace("ten", "other"))
    run("o", "--force")
    assert len(folders()) == len(before) + 1


def test_written_alignments(spark, tmp_path):
    """Files of many blocks, of samples dealt over tasks, come back whole and by region; reads without a place come last."""
    rng = np.random.default_rng(21)
    rows = []
    for i in range(3000):
        chrom = ("chr1", "chrX", None)[i % 3] if i % 50 else "chrQ"
        rows.append((f"s{i % 2}", f"r{i}", 0 if chrom else 4, chrom, int(rng.integers(0, 9_000_000)), "20M5D20M" if i % 2 else "40M", "ACGTN" * 8, "C+m,0;" if i % 4 == 0 else None, [i % 256] if i % 4 == 0 else None, i % 3 or None))
    write_reads(spark.createDataFrame(rows, ALIGNED).repartition(5), str(tmp_path / "o"), [("chr1", 1 << 24), ("chrX", 1 << 24)])
    path = str(tmp_path / "o/*.bam")
    assert sorted(p.name for p in (tmp_path / "o").iterdir()) == ["s0.bam", "s0.bam.bai", "s1.bam", "s1.bam.bai"] and bam.Blocks(str(tmp_path / "o/s0.bam")).next < (tmp_path / "o/s0.bam").stat().st_size
    got = {r.read_id: r for r in cli.bam(spark, path).collect()}
    assert len(got) == 3000
    for s, name, flag, chrom, pos, cigar, *_, ml, hp in rows:
        r, placed = got[name], chrom in ("chr1", "chrX")
        assert (r.sample, r.chrom, r.ref_start, r.hp, r.is_unmapped) == (s, chrom if placed else None, pos if placed else -1, hp, flag == 4)
        assert r.ref_end - r.ref_start == (45 if cigar == "20M5D20M" else 40) and [c.prob for c in r.calls] == (ml or [] if flag == 0 else [])
    for a, b in ((0, 100_000), (4_000_000, 4_300_000), (8_900_000, 1 << 29)):
        want = {name for _, name, _, chrom, pos, cigar, *_ in rows if chrom == "chrX" and pos < b and pos + (45 if cigar == "20M5D20M" else 40) > a}
        assert {r.read_id for r in cli.bam(spark, path, region=f"chrX:{a}-{b}").collect()} == want
    assert sum(r.mapped for r in cli.bam(spark, path, table="contigs").collect()) == sum(r[3] in ("chr1", "chrX") for r in rows)


def test_view_tables(spark):
    rng = np.random.default_rng(3)
    rows = []
    for s in range(12):
        for i in range(6):
            for hap in ("hap1", "hap2", "all"):
                m = 90 if (s, i) == (3, 2) else int(rng.integers(20, 40))
                rows.append((f"s{s}", f"i{i}", None if i == 1 else f"a name of locus {i} that is long", f"chr{i + 1}" if i < 5 else "chrX", i * 100, i * 100 + 50, 20, hap, 30, 100, m, 100 - m, m / 100))
    stats, scored = runs.cohort_run(spark.createDataFrame(rows, tables.COUNTS))
    made = runs.view_tables(scored, stats)
    top = made["manhattan_outlier_count"].where("island_id = 'i2'").first()
    assert (top.n_outliers, top.chrom, top.x_pos) == (1, "chr3", 491149951 + 225)
    label = made["sample_manhattan"].where("sample = 's3' AND island_id = 'i2'").first()
    assert label.label == "a name of locus 2…" and label.size > 6 and made["sample_manhattan"].where("chrom = 'chrX'").count() == 0
    assert made["sample_manhattan"].where("label IS NOT NULL").count() == made["sample_manhattan"].where("abs(z_score) >= 2.5").count()
    assert [r.island_id for r in made["loci"].orderBy("ord", "island_id").collect()] == [f"i{i}" for i in range(5)]
    assert made["manhattan_by_haplotype"].where("island_id = 'i2'").count() == 3
    assert made["methylation_embedding"].count() == 12
    shares = {r.axis: r.share for r in qc.axis_shares(qc.median_imputed(scored.where("haplotype = 'all'"))).collect()}
    assert 1 > shares["pc1"] >= shares["pc2"] > 0


def reads_table(spark, n=400):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        hap = int(rng.integers(1, 3))
        p = 0.95 if (hap == 1) else 0.05
        rows.append(("s", f"r{i}", "chrX", 3_000_000, 3_001_000, False, False, False, bool(i % 50 == 0), hap, [(3_000_100 + 10 * k, int(255 * (rng.random() < p))) for k in range(20)]))
    return spark.createDataFrame(rows, tables.READ_CALLS)


def test_xci_run(spark, tmp_path):
    islands = spark.createDataFrame([("chrX", 3_000_100, 3_000_300, "A"), ("chrX", 3_000_900, 3_002_000, "B"), ("chrX", 100_000, 100_200, "P")], "chrom string, start long, end long, name string")
    got = runs.xci_run(reads_table(spark), islands)
    row = got["per_island"].first()
    assert row.island_id == "A" and row.n_reads_hap1 + row.n_reads_hap2 == 392 and row.meth_frac_hap1 > 0.9 and row.meth_frac_hap2 < 0.1
    assert got["hemi"].count() == 1
    tables.write_bed9(got["track"], str(tmp_path / "track"), prefix="sample")
    lines = [x for f in (tmp_path / "track/sample=s").glob("part-*") for x in f.read_text().splitlines()]
    assert lines[0] == 'track name="sample_chrX_XCI" description="CpG island methylation bias chrX \u2014 sample" itemRgb="On"' and [x.split("\t")[3] for x in lines[1:]] == ["P|PAR", f"A|d=+{row.delta_meth:.2f}(h1={row.meth_frac_hap1:.0%},h2={row.meth_frac_hap2:.0%})", "B|no_data"]
    contigs = spark.createDataFrame([("s", "chrX", 900), ("s", "chrY", 10), ("m", "chrX", 100), ("m", "chrY", 90)], "sample string, contig string, mapped long")
    summary = runs.xci_summary("s", "s.bam", contigs, got, phasing_mode="pedigree", min_reads_per_hap=8)
    assert summary["xci_bias_hap1"] > 0.9 and (summary["inferred_sex"], summary["sex_check_chry_frac"]) == ("F", 0.011)
    assert (summary["n_islands_nonPAR"], summary["n_reads_retained"], summary["n_islands_sufficient_coverage"], summary["n_islands_hemi_methylated"]) == (2, 392, 1, 1)
    assert summary["meth_frac_hap1_median"] > 90 and summary["params"] == {"min_reads_per_hap": 8}
    backed = runs.xci_summary("s", "s.bam", contigs, got)
    assert {"xci_bias", "gmm_peak_low", "gmm_peak_high"} <= set(backed) and backed["xci_bias"] is None
    male = runs.xci_summary("m", "m.bam", contigs, None)
    assert male == {"sample": "m", "bam": "m.bam", "inferred_sex": "M", "sex_check_n_chrx_sampled": 100, "sex_check_n_chry_sampled": 90, "sex_check_chry_frac": 0.474, "phasing_mode": "read_backed", "params": {}}


def test_xci_of_many_samples(spark, tmp_path):
    """Summaries of all samples together are those of each alone; every sample has its own track, plots and fit."""
    rng, rows = np.random.default_rng(8), []
    for s in ("a", "b"):
        for isle in range(12):
            for i in range(40):
                hap = 1 + i % 2
                p = (0.9 if hap == 1 else 0.1) + (0.05 if s == "b" else 0) * (-1 if hap == 1 else 1)
                rows.append((s, f"{s}{isle}-{i}", "chrX", 3_000_000 + isle * 5000, 3_001_000 + isle * 5000, False, False, False, False, hap, [(3_000_100 + isle * 5000 + 10 * k, int(255 * (rng.random() < p))) for k in range(20)]))
    reads = spark.createDataFrame(rows, tables.READ_CALLS)
    islands = spark.createDataFrame([("chrX", 3_000_100 + k * 5000, 3_000_300 + k * 5000, f"i{k}") for k in range(12)] + [("chrX", 100_000, 100_200, "P")], "chrom string, start long, end long, name string")
    contigs = spark.createDataFrame([(s, "chrX", 900) for s in "ab"] + [("m", "chrX", 10), ("m", "chrY", 90), ("z", "chr1", 5)], "sample string, contig string, mapped long")
    got = runs.xci_run(reads, islands, meth_frac_thr=0.6)
    for mode in ("pedigree", "read_backed"):
        told = {r.sample: json.loads(r.json) for r in runs.xci_summaries(contigs, got, source="f.bam", phasing_mode=mode, min_reads_per_hap=8).collect()}
        for s in ("a", "b", "m"):
            alone = runs.xci_summary(s, "f.bam", contigs, got, phasing_mode=mode, min_reads_per_hap=8)
            assert list(told[s]) == list(alone) and told[s] == alone
        assert told["z"]["inferred_sex"] == "unknown" and told["z"]["n_reads_retained"] == 0
    assert told["a"]["gmm_peak_low"] < 20 < 80 < told["a"]["gmm_peak_high"]
    tables.write_bed9(got["track"], str(tmp_path / "t"))
    for s in "ab":
        lines = [x for f in (tmp_path / f"t/sample={s}").glob("part-*") for x in f.read_text().splitlines()]
        assert len(lines) == 14 and f'"{s}_chrX_XCI"' in lines[0] and [int(x.split("\t")[1]) for x in lines[1:]] == sorted(int(x.split("\t")[1]) for x in lines[1:])
    plots = runs.xci_plots(got["hemi"])
    assert plots["fits"].count() == 2 and plots["overlays"].count() == 2 * 2 * 2 * 500 and plots["scatter"].groupBy("sample").count().count() == 2
    heights = {r.plot: r.y for r in plots["overlays"].where("sample = 'a'").groupBy("plot").agg(F.max("y").alias("y")).collect()}
    assert heights["histogram"] == pytest.approx(heights["distribution"] * 24 * 2)


def test_exact_quantiles(spark):
    """Rounds that narrow to a few rows give numpy's quantiles: ties, heavy tails, null keys, groups without values."""
    rng = np.random.default_rng(2)
    groups = {"u": rng.random(5000), "tied": np.repeat([1.0, 2.0, 2.5], [3000, 10, 1990]), "tail": np.exp(rng.normal(0, 40, 4000)), "one": np.array([7.0]), None: rng.integers(-9, 9, 3000) / 4, "two": np.array([1.0, 2.0])}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("none", None), ("u", float("nan")), ("u", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    probs = (0.0, 0.001, 0.25, 0.5, 0.9, 1.0)
    for most in (1 << 20, 300, 20):
        got = {r.k: (r.n, r.q) for r in ranks.exact_quantiles(df, ["k"], "v", probs, rows=most).collect()}
        assert got.pop("none") == (0, None) and set(got) == set(groups)
        for k, (n, q) in got.items():
            assert n == len(groups[k]) and q == pytest.approx(list(np.quantile(groups[k], probs)), rel=1e-12)
    assert ranks.exact_quantiles(df.limit(0), ["k"], "v", probs).collect() == []


def test_first_per_group(spark):
    """More rows than a group limit takes, among ties and nulls; no rank twice."""
    rng = np.random.default_rng(9)
    rows = [(("a", "b", None)[i % 3], None if i % 10 == 0 else float(rng.integers(0, 40)) / 4, f"t{i}") for i in range(9000)]
    df = spark.createDataFrame(rows, "g string, z double, t string")
    for k in (1, 1500, 10_000):
        got = {(r.g, r["rank"]): r.t for r in ranks.first_per_group(df, ["g"], F.abs("z"), ["t"], k).collect()}
        for g in ("a", "b", None):
            want = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))[:k]
            assert [got[g, i + 1] for i in range(len(want))] == [r[2] for r in want]
        assert len(got) == 3 * min(k, 3000)


def test_ranked(spark):
    df = spark.range(1000).selectExpr("id", "id * 7919 % 500 AS v", "CASE WHEN id % 9 = 0 THEN NULL ELSE id % 4 END AS w").repartition(7)
    got = {r.id: r["rank"] for r in intervals.ranked(df, [F.desc("v"), "w", "id"]).collect()}
    want = sorted(((-(i * 7919 % 500), -1 if i % 9 == 0 else i % 4, i) for i in range(1000)))
    assert [got[i] for *_, i in want] == list(range(1000))


def test_ranges_of_their_own(spark):
    """Histograms over the data's range count every value, also islands longer than any fixed end."""
    rows = [("a", float(v)) for v in (200, 300, 4999, 5000, 45_712)] + [("b", 3.0)] * 4 + [("c", None)]
    got = views.histogram(spark.createDataFrame(rows, "k string, v double"), "v", bins=10, keys=["k"]).collect()
    assert {(r.k, r.bin): r.n for r in got} == {("a", 1): 2, ("a", 2): 2, ("a", 10): 1, ("b", 1): 4}
    ends = {(r.k, r.bin): (r.low, r.high) for r in got}
    assert ends["a", 1] == (200, 200 + 4551.2) and ends["a", 10][1] == pytest.approx(45_712) and ends["b", 1] == (3, 3)
    stats = spark.createDataFrame([("all", 0, 200 + 50 * k + (40_000 if k == 7 else 0), 10 + k, k / 900 if k % 3 else None) for k in range(889)], "haplotype string, island_start long, island_end long, island_cpgNum long, cohort_mean double")
    told = {r.panel: r.n for r in views.locus_distributions(stats).groupBy("panel").agg(F.sum("n").alias("n")).collect()}
    assert told == {"island_size": 889, "island_cpgNum": 889, "cohort_mean": 592}


def test_components_of_many(spark):
    """A matrix larger than the finder's width on both sides, with axes that stand out, against a full decomposition."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(90, 3)) * (6, 4, 1) @ rng.normal(size=(3, 120)) + rng.normal(size=(90, 120)) + 5
    x[:, 7] = 2.0
    df = spark.createDataFrame([(f"s{i:03}", f"l{j:03}", float(x[i, j])) for i in range(90) for j in range(120)], "sample string, island_id string, frac_meth double")
    sd = x.std(0)
    z = (x - x.mean(0)) / np.where(sd > 1e-12, sd, 1)
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    want = u[:, :2] * s[:2]
    want *= np.sign(want[np.abs(want).argmax(0), range(2)])
    axes = qc.principal_components(df)
    got = {r.sample: (r.pc1, r.pc2) for r in axes.collect()}
    assert np.allclose([got[f"s{i:03}"] for i in range(90)], want, atol=1e-6)
    shares = {r.axis: r.share for r in qc.axis_shares(df, axes=axes).collect()}
    assert shares["pc1"] == pytest.approx(s[0] ** 2 / (z**2).sum(), abs=1e-9)
    assert qc.principal_components(df.where("sample < 's002'")).collect() == []
    plan = axes._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "collect_list" not in plan


def test_kde_of_cells(spark):
    """Densities from cells' moments are those of all kernels, to the last places, at any spread and for values off the grid."""
    rng = np.random.default_rng(12)
    groups = {"wide": rng.uniform(-50, 150, 700), "narrow": rng.normal(40, 0.3, 500), "far": np.append(rng.normal(50, 1, 50), 1e4), None: np.array([10.0, 20.0, 40.0])}
    df = spark.createDataFrame([(k, float(v)) for k, x in groups.items() for v in x] + [("one", 3.0), ("flat", 2.0), ("flat", 2.0), ("wide", None)], "k string, pct double")
    got = {}
    for r in xci.kde(df, keys=["k"], points=201).collect():
        got.setdefault(r.k, {})[r.i] = r.density
    assert set(got) == set(groups)
    for k, v in groups.items():
        h, x = v.std(ddof=1) * len(v) ** -0.2, np.linspace(0, 100, 201)
        want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * (2 * np.pi) ** 0.5)
        assert np.allclose([got[k].get(i, 0.0) for i in range(201)], want, rtol=1e-9, atol=1e-13)


def test_mixtures_of_groups(spark):
    rng = np.random.default_rng(3)
    groups = {"a": np.concatenate([rng.normal(20, 4, 300), rng.normal(80, 6, 100)]), "b": np.concatenate([rng.normal(30, 2, 50), rng.normal(60, 6, 150)]), None: rng.normal(50, 1, 40)}
    df = spark.createDataFrame([(k, float(v)) for k, x in groups.items() for v in x] + [("few", 1.0)] * 9 + [("a", None)], "k string, pct double")
    got = {r.k: r.asDict() for r in xci.gaussian_mixtures(df, ["k"]).collect()}
    assert set(got) == set(groups)
    for k, fit in got.items():
        alone = xci.gaussian_mixture(df.where(F.col("k").eqNullSafe(k)))
        assert all(fit[c] == pytest.approx(alone[c], rel=1e-6) for c in alone) and fit["n"] == len(groups[k])
    assert len({fit["rounds"] for fit in got.values()}) > 1
    assert xci.gaussian_mixtures(df.where("k = 'few'"), ["k"]).collect() == []


def test_incremental_cohort(spark, tmp_path):
    """States after batches, among repeats and a batch that runs twice, give what a run over all counts gives."""
    rng, rows = np.random.default_rng(13), []
    for s in range(20):
        for i in range(5):
            for hap in ("all", "hap1", None):
                rows.append((f"s{s}", f"i{i}", hap, None if rng.random() < 0.1 else round(float(rng.random()), 4)))
    df = spark.createDataFrame(rows, "sample string, island_id string, haplotype string, frac_meth double")
    states = CohortStates(spark, str(tmp_path / "c"))
    assert states.stats() is None
    cols = ["island_id", "haplotype", "cohort_n_samples", "cohort_mean", "cohort_std", "cohort_median", "cohort_q25", "cohort_q75", "cohort_min", "cohort_max", "cohort_IQR"]
    part = lambda k: df.where(F.expr("int(substring(sample, 2)) % 4") == k)

    def same(whole):
        key = lambda r: str(tuple(r)[:2])
        for a, b in zip(sorted(states.stats().select(cols).collect(), key=key), sorted(cohort.locus_stats(whole).select(cols).collect(), key=key), strict=True):
            assert tuple(a)[:3] == tuple(b)[:3] and all(x == y or x == pytest.approx(y, abs=1e-12) for x, y in zip(a[3:], b[3:]))

    assert states.add(part(0), 0) == 0 and states.add(part(1).union(part(0)), 1) == 75
    same(df.where("int(substring(sample, 2)) % 4 < 2"))
    assert states.add(part(2), 2) == 0 and states.add(part(2), 2) == 0
    states.compact(2)
    assert states.add(part(3).union(part(3)), 3) == 75
    same(df)


def test_xci_command(spark, tmp_path):
    """The command on a glob of three samples: tables, tracks and plots of the two that aren't male, a summary of each."""
    rows = []
    for s in ("a", "b", "m"):
        for isle in range(12):
            for i in range(24):
                calls = [240 if (i % 2 == 0) != (i % 12 == 0) else 10] * 12
                rows.append((s, f"{s}{isle}-{i}", 0, "chrX", 3_000_000 + isle * 5000, "24M", "CG" * 12, "C+m" + ",0" * 12 + ";", calls, 1 + i % 2))
        rows += [(s, f"{s}y{i}", 0, "chrY", i, "4M", "ACGT", None, None, None) for i in range(400 if s == "m" else 1)]
    write_reads(spark.createDataFrame(rows, ALIGNED), str(tmp_path / "bam"), [("chrX", 1 << 24), ("chrY", 1 << 24)])
    (tmp_path / "i.bed").write_text("".join(f"chrX\t{3_000_000 + k * 5000}\t{3_000_024 + k * 5000}\tCpG\n" for k in range(12)) + "chrX\t100000\t100100\tP\n")
    run = lambda glob, out: cli.main(["xci", "--bam_glob", str(tmp_path / glob), "--cpg_islands", str(tmp_path / "i.bed"), "--outdir", str(tmp_path / out)], spark)
    run("bam/*.bam", "o")
    read = lambda name: spark.read.csv(str(tmp_path / "o" / name), sep="\t", header=True)
    assert {r.sample: r["count"] for r in read("per_read").groupBy("sample").count().collect()} == {"a": 288, "b": 288} and read("per_island").count() == 24
    told = {f.parent.name[7:]: json.loads(f.read_text()) for f in (tmp_path / "o/summary").glob("sample=*/part-*") if f.read_text()}
    assert {s: x["inferred_sex"] for s, x in told.items()} == {"a": "F", "b": "F", "m": "M"} and "xci_bias" not in told["m"] and told["a"]["n_islands_hemi_methylated"] == 12 and told["a"]["xci_bias"] is not None
    tracks = {f.parent.name[7:]: f.read_text().splitlines() for f in (tmp_path / "o/track").glob("sample=*/part-*") if f.read_text()}
    assert set(tracks) == {"a", "b"} and len(tracks["a"]) == 14 and "P|PAR" in tracks["a"][1]
    assert read("xci_overlays").count() == 2 * 2 * 2 * 500 and read("xci_fits").count() == 2 and read("xci_scatter").count() == 24
    run("bam/m.bam", "male")
    assert json.loads(next(f.read_text() for f in (tmp_path / "male/summary").glob("sample=m/part-*") if f.read_text()))["inferred_sex"] == "M"


def test_cohort_files(spark, tmp_path):
    rng = np.random.default_rng(6)
    lines = ["\t".join(tables.COUNTS.replace(" string", "").replace(" long", "").replace(" double", "").split(", "))]
    for s in range(7):
        for i in range(4):
            for hap in ("hap1", "all"):
                m = int(rng.integers(10, 90))
                lines.append("\t".join(map(str, (f"s{s}", f"chr1:{i}-9", "", "chr1", i, 9, 12, hap, 20, 100, m, 100 - m, m / 100))))
    (tmp_path / "counts.tsv").write_text("\n".join(lines) + "\n")
    (tmp_path / "no.txt").write_text("s6 # out\n")
    cli.main(["cohort", "--counts", str(tmp_path / "counts.tsv"), "--outdir", str(tmp_path / "o"), "--exclude_samples", str(tmp_path / "no.txt")], spark)
    back = spark.read.csv(str(tmp_path / "o/all_samples_stats"), sep="\t", header=True)
    assert back.columns == tables.STATS_ORDER and back.count() == 6 * 8
    stats, scored = runs.cohort_run(tables.read_counts(spark, str(tmp_path / "counts.tsv")), leave_one_out=True)
    assert stats.count() == 8 and scored.where("z_score IS NULL").count() == 0 and not math.isnan(scored.first().z_score)
    cli.main(["qc", "--counts", str(tmp_path / "counts.tsv"), "--outdir", str(tmp_path / "q")], spark)
    text = [x for f in (tmp_path / "q/samples_exclude").glob("part-*") for x in f.read_text().splitlines()]
    assert [x for x in text if not x.startswith("#")] == [] and "# (none)" in text and text[-7:] == [f"# s{i}" for i in range(7)]
    assert spark.read.csv(str(tmp_path / "q/qc_records"), sep="\t", header=True).count() == 7
    cli.main(["views", "--stats", str(tmp_path / "o/all_samples_stats"), "--outdir", str(tmp_path / "v")], spark)
    views_made = {p.name for p in (tmp_path / "v").iterdir()}
    assert {"manhattan_outlier_count", "locus_distributions", "sample_manhattan", "loci", "locus_boxes", "methylation_embedding"} <= views_made
    assert spark.read.csv(str(tmp_path / "v/loci"), sep="\t", header=True).count() == 4
    rows, stats_back, out_back = tables.read_scored(spark, str(tmp_path / "o/all_samples_stats"))
    assert stats_back.count() == 8 and out_back is not None and dict(rows.dtypes)["outlier"] == "boolean" and rows.where("outlier IS NULL").count() == 0
    (tmp_path / "empty.tsv").write_text("")
    assert tables.read_counts(spark, [str(tmp_path / "counts.tsv"), str(tmp_path / "empty.tsv"), str(tmp_path / "absent.tsv")]).count() == 56
    (tmp_path / "bad.tsv").write_text("sample\tisland_id\ns\ti\n")
    with pytest.raises(ValueError, match="haplotype"):
        tables.read_counts(spark, str(tmp_path / "bad.tsv"))


def test_counts_store(spark, tmp_path):
    """Only what is new is made: samples, marks, parameters; samples without counts are remembered too, and what a run left half done isn't read."""
    made = []

    def make(samples):
        made.append(samples)
        row = lambda s: (s, "i", None, "chr1", 1, 2, 3, "all", len(made), 2, 1, 1, 0.5)
        return spark.createDataFrame([row(s) for s in samples if s != "none"], tables.COUNTS)

    def get(samples, cut=0.5, **how):
        marks = spark.createDataFrame([(s, m) for s, m in samples.items()], "sample string, mark string")
        return {r.sample: r.n_reads for r in tables.stored_counts(marks, str(tmp_path / "s"), {"cut": cut}, make, **how).collect()}

    assert get({}) == {} and made == []
    assert get({"a": "1", "none": "1"}) == {"a": 1} and get({"a": "1", "none": "1", "b": "1"}) == {"a": 1, "b": 2}
    assert get({"none": "1", "b": "1"}) == {"b": 2}
    assert get({"a": "2", "b": "1"}) == {"a": 3, "b": 2} and get({"a": "1"}) == {"a": 1}
    assert get({"a": "1"}, 0.7) == {"a": 4} and get({"b": "1"}, force=True) == {"b": 5} and get({"a": "1", "b": "1"}) == {"a": 1, "b": 5}
    assert made == [["a", "none"], ["b"], ["a"], ["a"], ["b"]]
    make(["a"]).write.parquet(str(tmp_path / "s/counts/unlisted"))
    assert get({"a": "1", "b": "1"}) == {"a": 1, "b": 5}
    one, two = spark.range(5), spark.range(5).repartition(3)
    assert tables.content_mark(one) == tables.content_mark(two) != tables.content_mark(spark.range(6))


def test_headers(spark, tmp_path):
    """Files are read by their own headers, in whatever order and with whatever more."""
    names = [k.split(" ")[0] for k in tables.COUNTS.split(", ")]
    row = dict(zip(names, ("s1", "i", "n", "chr1", 1, 2, 3, "all", 200, 20, 5, 15, 0.25)))
    for i, order in enumerate((names, names[::-1], [*names, "more"])):
        told = row | {"sample": f"s{i}", "more": "x"}
        (tmp_path / f"{i} {{a,b}}.tsv").write_text("\t".join(order) + "\n" + "\t".join(str(told[c]) for c in order) + "\n")
    (tmp_path / "empty.tsv").write_text("")
    (tmp_path / "only.tsv").write_text("\t".join(names) + "\n")
    for i in range(3):
        (tmp_path / f"{i} {{a,b}}.tsv").rename(tmp_path / f"{i},x.tsv")
    got = tables.read_counts(spark, [str(tmp_path / f) for f in ("0,x.tsv", "1,x.tsv", "2,x.tsv", "empty.tsv", "only.tsv", "absent.tsv")])
    assert sorted((r.sample, r.n_reads, r.n_cpg_total, r.island_start, r.more) for r in got.collect()) == [("s0", 200, 20, 1, None), ("s1", 200, 20, 1, None), ("s2", 200, 20, 1, "x")]
    assert [len(files) for _, files in tables.headers(spark, [str(tmp_path / f) for f in ("0,x.tsv", "only.tsv", "1,x.tsv", "empty.tsv")])] in ([1, 2], [2, 1])
    assert tables.read_counts(spark, str(tmp_path / "*,x.tsv")).count() == 3
    assert tables.read_by_header(spark, [str(tmp_path / "absent.tsv"), str(tmp_path / "no/absent.tsv")]) is None
    with pytest.raises(ValueError, match="no counts"):
        tables.read_counts(spark, str(tmp_path / "empty.tsv"))


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    header = tables.COUNTS.replace(" string", "").replace(" long", "").replace(" double", "").replace(", ", "\t")
    row = "s\ti\tn\tchr1\t1\t2\t12\tall\t20\t100\t50\t50\t0.5"
    (tmp_path / "in/a.tsv").write_text(f"{header}\n{row}\n{row}\n")
    for more in (1, 2):
        q = append_counts(counts_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"))
        q.awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / "out")).count() == more
        (tmp_path / "in/b.tsv").write_text(f"{header}\n{row.replace('s', 'z', 1)}\n")


def test_read_batches_are_bounded(spark, tmp_path, monkeypatch):
    """Long reads leave the reader in batches of a bounded number of calls, and all of them come."""
    rows = [("s", f"r{i}", 0, "chr1", i, "600M", "CG" * 300, "C+m" + ",0" * 300 + ";", [200] * 300, None) for i in range(50)]
    write_reads(spark.createDataFrame(rows, ALIGNED), str(tmp_path), [("chr1", 1 << 20)])
    monkeypatch.setattr(bam, "BATCH", 1000)
    reader = bam.BamReader({"path": str(tmp_path / "*.bam")})
    got = [b for p in reader.partitions() for b in reader.read(p)]
    assert all(sum(len(c) for c in b.column("calls").to_pylist()) <= 1200 for b in got)
    told = [r for b in got for r in b.to_pylist()]
    assert [r["read_id"] for r in told] == [f"r{i}" for i in range(50)] and all(len(r["calls"]) == 300 and r["calls"][0] == {"rpos": r["ref_start"], "prob": 200} and r["hp"] is None for r in told)
