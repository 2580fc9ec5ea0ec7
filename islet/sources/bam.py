"""A Spark data source for aligned reads with base modifications, rows as in READ_CALLS, and for the contig counts of their indexes.

With a ``.bai`` index beside a file, its reads are dealt over many input partitions. Regions (as an option, or as filters on
chrom, ref_start and ref_end that Spark pushes down) are looked up in the index: only the chunks of the file that its bins and windows
name for them are read, merged over all regions. Without an index a file is one partition, read whole.
"""

from __future__ import annotations

import fnmatch
import glob
import gzip
import os
import struct
import warnings
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from islet.sources.tables import READ_CALLS

_BASES = "=ACMGRSVTWYHKDBN"
CONTIGS = "sample string, contig string, mapped long"
SPLIT = 16 << 20  # compressed bytes of a partition of an indexed file
BATCH = 1 << 16  # calls, and reads without any, of a batch of rows: one read at least
_CALLS = pa.list_(pa.struct([("rpos", pa.int64()), ("prob", pa.int32())]))
_ROW = pa.schema([(c, {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[t]) for c, t in (x.split(" ") for x in READ_CALLS.split(", calls ")[0].split(", "))] + [("calls", _CALLS)])
#: Fixed values of the index format: the bin that holds counts instead of places, the bits of a window, and by level the first bin and the bits of its span.
_COUNTS_BIN, _WINDOW, _LEVELS = 37450, 14, ((0, 29), (1, 26), (9, 23), (73, 20), (585, 17), (4681, 14))
_FAR = 1 << 29  # the end of what the index can tell
_TYPES = {"A": "c", "c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def tags(data: bytes) -> dict:
    """Optional fields of a record: numbers, texts and arrays by name."""
    out, at = {}, 0
    while at + 3 <= len(data):
        name, kind, at = data[at : at + 2].decode(), chr(data[at + 2]), at + 3
        if kind in "ZH":
            end = data.index(0, at)
            out[name], at = data[at:end].decode(), end + 1
        elif kind == "B":
            code, n = _TYPES[chr(data[at])], struct.unpack_from("<I", data, at + 1)[0]
            out[name] = struct.unpack_from(f"<{n}{code}", data, at + 5)
            at += 5 + n * struct.calcsize(code)
        else:
            out[name] = struct.unpack_from(f"<{_TYPES[kind]}", data, at)[0]
            at += struct.calcsize(_TYPES[kind])
    return out


def reference_positions(start: int, cigar: list[tuple[int, int]]) -> dict[int, int]:
    """Query position -> reference position of aligned bases."""
    out, q, r = {}, 0, start
    for op, n in cigar:
        if op in (0, 7, 8):
            out.update(zip(range(q, q + n), range(r, r + n)))
        q += n * (op in (0, 1, 4, 7, 8))
        r += n * (op in (0, 2, 3, 7, 8))
    return out


def methylated_cytosines(sequence: str, reverse: bool, mm: str, ml: tuple) -> dict[int, int]:
    """Query position -> probability (0-255) of 5-methylcytosine on either strand."""
    turned = sequence[::-1].translate(str.maketrans("ACGTN", "TGCAN")) if reverse else sequence
    out, used = {}, 0
    for group in filter(None, mm.split(";")):
        head, *skips = group.rstrip().split(",")
        base, codes = head[0], head[2:].rstrip("?.")
        # codes are letters, one probability each and call, or one number
        width = 1 if codes.isdigit() else len(codes)
        seen = [i for i, b in enumerate(turned) if b == base or base == "N"]
        at = -1
        for k, skip in enumerate(map(int, skips)):
            at += skip + 1
            if base == "C" and "m" in codes and at < len(seen):
                place = seen[at]
                out[len(turned) - 1 - place if reverse else place] = ml[used + k * width + codes.index("m")]
        used += len(skips) * width
    return out


def opened(path: str) -> BinaryIO:
    """A local file, or one of a store that pyarrow knows by its scheme (file, hdfs, s3, gs)."""
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def listed(pattern: str) -> list[str]:
    """Paths that match a glob, in order; of a store, the last part of the path may have wildcards."""
    if "://" not in pattern:
        return sorted(glob.glob(pattern))
    from pyarrow import fs

    folder, _, name = pattern.rpartition("/")
    store, inside = fs.FileSystem.from_uri(folder)
    found = store.get_file_info(fs.FileSelector(inside, allow_not_found=True))
    return sorted(f"{folder}/{f.base_name}" for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, name))


def exists(path: str) -> bool:
    return bool(listed(path)) if "://" in path else os.path.isfile(path)


class Blocks:
    """Decompressed bytes of a blocked file from a virtual offset on (block's place << 16 | place in the block); ``fetched`` counts the file's bytes read."""

    def __init__(self, path: str, offset: int = 0):
        self.file, self.fetched = opened(path), 0
        self.seek(offset)

    def seek(self, offset: int) -> None:
        self.data, self.at, self.block, self.next = b"", 0, 0, offset >> 16
        self._load()
        self.at = offset & 0xFFFF

    def close(self) -> None:
        self.file.close()

    def _load(self) -> bool:
        self.file.seek(self.next)
        head = self.file.read(12)
        if len(head) < 12:
            return False
        extra = self.file.read(struct.unpack_from("<H", head, 10)[0])
        at = 0
        while extra[at : at + 2] != b"BC":
            at += 4 + struct.unpack_from("<H", extra, at + 2)[0]
        size = struct.unpack_from("<H", extra, at + 4)[0] + 1
        body = self.file.read(size - 12 - len(extra))
        self.fetched += size
        self.block, self.next, self.at = self.next, self.next + size, 0
        self.data = zlib.decompress(body[:-8], -15)
        return True

    def offset(self) -> int:
        while self.at >= len(self.data) and self._load():
            pass
        return self.block << 16 | self.at

    def read(self, n: int) -> bytes:
        out = []
        while n:
            if self.at >= len(self.data) and not self._load():
                break
            piece = self.data[self.at : self.at + n]
            self.at += len(piece)
            n -= len(piece)
            out.append(piece)
        return b"".join(out)


def contig_names(f) -> list[str]:
    if f.read(4) != b"BAM\1":
        raise ValueError("not an alignment file")
    number = lambda: struct.unpack("<i", f.read(4))[0]
    f.read(number())
    out = []
    for _ in range(number()):
        out.append(f.read(number())[:-1].decode())
        f.read(4)
    return out


class Contig(NamedTuple):
    """What an index tells of a contig: the chunks (from, to: virtual offsets) of each bin, the offset of each window's first read, and mapped reads."""

    bins: dict[int, list[tuple[int, int]]]
    windows: tuple[int, ...]
    mapped: int

    def chunks(self, regions: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
        """Chunks that may hold reads overlapping one of the regions, merged and in order.

        A read lies in the smallest bin that holds it whole, so a region's reads are in the bins of each level that meet it; and a
        read that overlaps a region begins no earlier in the file than the first read of the region's first window.
        """
        found = set()
        for start, end in regions:
            start, end = max(start, 0), min(end, _FAR)
            if start >= end:
                continue
            window = start >> _WINDOW
            least = self.windows[window] if window < len(self.windows) else 0
            for first, bits in _LEVELS:
                low, high = first + (start >> bits), first + ((end - 1) >> bits)
                some = range(low, high + 1) if high - low < len(self.bins) else (b for b in self.bins if low <= b <= high)
                found.update((max(a, least), b) for n in some for a, b in self.bins.get(n, ()) if b > least)
        return merged(found)


def merged(chunks: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Chunks in order; those that overlap or meet in a block are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(chunks):
        if out and a >> 16 <= out[-1][1] >> 16:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def read_index(path: str) -> list[Contig]:
    with opened(path) as f:
        data = f.read()
    if data[:4] != b"BAI\1":
        raise ValueError(f"not an index: {path}")
    at, out = 4, []

    def take(form: str) -> tuple:
        nonlocal at
        got = struct.unpack_from(form, data, at)
        at += struct.calcsize(form)
        return got

    for _ in range(take("<i")[0]):
        bins, mapped = {}, 0
        for _ in range(take("<i")[0]):
            number, n = take("<Ii")
            chunks = take(f"<{2 * n}Q")
            if number == _COUNTS_BIN:
                mapped = chunks[2]
            else:
                bins[number] = list(zip(chunks[::2], chunks[1::2]))
        windows = take(f"<{take('<i')[0]}Q")
        out.append(Contig(bins, windows, mapped))
    return out


def index_of(path: str) -> str | None:
    """The index beside a file, under either usual name; a warning where there is none."""
    for name in (f"{path}.bai", f"{path.removesuffix('.bam')}.bai"):
        if exists(name):
            return name
    warnings.warn(f"no index beside {path}: it is read whole, by one task", stacklevel=2)
    return None


def record(block: bytes, contigs: list[str]) -> tuple:
    """A read, without its sample."""
    ref, pos, n_name, _, _, n_cigar, flag, n_seq = struct.unpack_from("<iiBBHHHi", block)
    at = 32
    name = block[at : at + n_name - 1].decode()
    at += n_name
    cigar = [(c & 15, c >> 4) for c in struct.unpack_from(f"<{n_cigar}I", block, at)]
    at += 4 * n_cigar
    packed = block[at : at + (n_seq + 1) // 2]
    sequence = "".join(_BASES[b >> 4] + _BASES[b & 15] for b in packed)[:n_seq]
    more = tags(block[at + len(packed) + n_seq :])
    calls = []
    mm, ml = more.get("MM", more.get("Mm")), more.get("ML", more.get("Ml"))
    if mm and ml and not flag & 4:
        places = reference_positions(pos, cigar)
        found = methylated_cytosines(sequence, bool(flag & 16), mm, ml)
        calls = [{"rpos": places[q], "prob": p} for q, p in sorted(found.items()) if q in places]
    end = pos + sum(n for op, n in cigar if op in (0, 2, 3, 7, 8))
    return name, contigs[ref] if ref >= 0 else None, pos, end, bool(flag & 4), bool(flag & 256), bool(flag & 2048), bool(flag & 1024), more.get("HP"), calls


def records(path: str, chunks: Sequence[tuple[int, int | None]] | None = None) -> Iterator[tuple]:
    """The file's reads, or those that begin in the chunks (from, to: virtual offsets; to the end without one)."""
    if chunks is None:
        with opened(path) as raw, gzip.open(raw) as f:
            contigs = contig_names(f)
            while head := f.read(4):
                yield record(f.read(struct.unpack("<i", head)[0]), contigs)
        return
    f = Blocks(path)
    contigs = contig_names(f)
    for start, stop in chunks:
        f.seek(start)
        while (stop is None or f.offset() < stop) and len(head := f.read(4)) == 4:
            yield record(f.read(struct.unpack("<i", head)[0]), contigs)
    f.close()


def batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of some BATCH calls, so that a task holds no more of them, however long the reads are."""
    held, n = [], 0

    def made() -> pa.RecordBatch:
        columns = list(zip(*held))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROW)], schema=_ROW)

    for row in rows:
        held.append(row)
        n += 1 + len(row[-1])
        if n >= BATCH:
            yield made()
            held, n = [], 0
    if held:
        yield made()


class Regions:
    """Spans by contig, merged and in order, so that a read is looked up in a few steps."""

    def __init__(self, spans: Iterable[tuple[str, int, int]]):
        self.by: dict[str, list[tuple[int, int]]] = {}
        for contig, start, end in sorted(spans):
            mine = self.by.setdefault(contig, [])
            if mine and start <= mine[-1][1]:
                mine[-1] = (mine[-1][0], max(end, mine[-1][1]))
            elif start < end:
                mine.append((start, end))
        self.starts = {c: [a for a, _ in spans] for c, spans in self.by.items()}

    def meet(self, contig: str | None, start: int, end: int) -> bool:
        """Whether a read overlaps a span: then the last span that begins before its end reaches past its start."""
        mine = self.by.get(contig)
        at = bisect_right(self.starts[contig], end - 1) if mine else 0
        return at > 0 and mine[at - 1][1] > start

    def within(self, contig: str | None, start: int, end: int) -> Regions:
        """What of the spans lies on a contig and overlaps the span."""
        return Regions((c, max(a, start), min(b, end)) for c, spans in self.by.items() if contig in (None, c) for a, b in spans if a < end and b > start)


def regions_of(text: str | None) -> Regions | None:
    """``contig`` or ``contig:start-end``, from 0, end exclusive; several are joined by tabs."""
    if not text:
        return None
    out = []
    for one in text.split("\t"):
        contig, _, span = one.rpartition(":")
        if not contig or not span.replace(",", "").replace("-", "").isdigit():
            contig, span = one, ""
        start, _, end = span.replace(",", "").partition("-")
        out.append((contig, int(start or 0), int(end or 1 << 60)))
    return Regions(out)


def regions_text(spans: Iterable[tuple[str, int, int]], near: int = 1 << _WINDOW) -> str:
    """Spans as an option's text. Those closer than the index can tell apart are one, so a genome has at most its length over ``near``."""
    out: list[list] = []
    for contig, start, end in sorted(spans):
        if out and out[-1][0] == contig and start - out[-1][2] < near:
            out[-1][2] = max(out[-1][2], end)
        else:
            out.append([contig, start, end])
    return "\t".join(f"{c}:{a}-{b}" for c, a, b in out)


class Part(InputPartition):
    """Chunks of a file, or the whole of it."""

    def __init__(self, path: str, chunks: list[tuple[int, int | None]] | None = None):
        super().__init__(path)
        self.path, self.chunks = path, chunks


def split(chunks: Iterable[tuple[int, int]], windows: Sequence[int], size: int) -> list[list[tuple[int, int]]]:
    """Chunks in groups of about ``size`` compressed bytes; a larger chunk is cut where a window's first read begins."""
    cuts, out, held = sorted({w for w in windows if w}), [], []
    for a, b in chunks:
        for w in cuts[bisect_right(cuts, a) :]:
            if w >= b:
                break
            if (w >> 16) - (a >> 16) >= size:
                held.append((a, w))
                out.append(held)
                held, a = [], w
        held.append((a, b))
        if sum((y >> 16) - (x >> 16) for x, y in held) >= size:
            out.append(held)
            held = []
    return [*out, held] if held else out


def parts(path: str, regions: Regions | None) -> list[Part]:
    """A file's partitions: with an index, of about SPLIT compressed bytes, and only the chunks that may overlap the regions."""
    index = index_of(path)
    if index is None:
        return [Part(path)]
    head = Blocks(path)
    names, contigs, out, end = contig_names(head), read_index(index), [], head.offset()
    head.close()
    for name, contig in zip(names, contigs):
        end = max([end, *(b for chunks in contig.bins.values() for _, b in chunks)])
        spans = [(0, _FAR)] if regions is None else regions.by.get(name, [])
        out += [Part(path, chunks) for chunks in split(contig.chunks(spans), contig.windows, SPLIT)]
    return [*out, Part(path, [(end, None)])] if regions is None else out


class BamReader(DataSourceReader):
    def __init__(self, options):
        self.paths = listed(options["path"])[: int(options.get("max_files", 1 << 30))]
        if not self.paths:
            raise ValueError(f"no alignment files: {options['path']}")
        if options.get("samples") is not None:
            some = set(options["samples"].split("\t"))
            self.paths = [p for p in self.paths if sample_of(p) in some]
        self.contigs, self.regions = options.get("table", "reads") == "contigs", regions_of(options.get("region"))

    def partitions(self):
        return [Part(p) for p in self.paths] if self.contigs else [part for p in self.paths for part in parts(p, self.regions)]

    def read(self, partition):
        if partition is None:  # no partitions
            return
        sample = sample_of(partition.path)
        if self.contigs:
            index = index_of(partition.path)
            if index is None:
                raise ValueError(f"contig counts need an index beside {partition.path}")
            for name, contig in zip(contig_names(Blocks(partition.path)), read_index(index)):
                yield sample, name, contig.mapped
            return
        rows = records(partition.path, partition.chunks)
        yield from batches((sample, *row) for row in rows if self.regions is None or self.regions.meet(row[1], row[2], max(row[3], row[2] + 1)))


class PushedReader(BamReader):
    """A reader that Spark's filters narrow. Spark only takes one where ``spark.sql.python.filterPushdown.enabled`` is set.

    Spark (4.1) keeps the narrowed reader with the loaded table, so each query must load its own: the region option has no such limit.
    """

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Samples, contigs and bounds of a read's places narrow what is read; Spark still applies all filters.

        A read past ``ref_start < e`` and ``ref_end > s`` overlaps [s, e), or ends where it begins; those too have a base in the
        span one wider on both sides. One on a contig alone narrows as well.
        """
        contig, low, high = None, 0, 1 << 60
        for f in filters:
            yield f
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if isinstance(f, EqualTo) and column == "sample":
                self.paths = [p for p in self.paths if sample_of(p) == f.value]
            elif isinstance(f, EqualTo) and column == "chrom":
                contig = f.value
            elif isinstance(f, (LessThan, LessThanOrEqual)) and column == "ref_start":
                high = min(high, f.value + 2)
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)) and column == "ref_end":
                low = max(low, f.value - 2)
        if contig is not None and not self.contigs:
            self.regions = self.regions.within(contig, low, high) if self.regions else Regions([(contig, low, high)])


def sample_of(path: str) -> str:
    return os.path.basename(path).split(".")[0]


class BamSource(DataSource):
    """``spark.dataSource.register(BamSource)``, then ``spark.read.format("islet_bam").option("path", "dir/*.bam").load()``.

    Options: path (a glob; also of a store that pyarrow knows), max_files (the first so many by name), samples (tab-joined), region
    (``chrX`` or ``chrX:0-1000``, tab-joined), and table: ``reads``, or ``contigs`` for each contig's mapped reads by the index, without
    reading the file; pushdown, ``true`` where ``spark.sql.python.filterPushdown.enabled`` is set: filters on sample, chrom, ref_start and
    ref_end then narrow what is read too. A table loaded so is for one query alone (see ``PushedReader``).
    """

    @classmethod
    def name(cls) -> str:
        return "islet_bam"

    def schema(self):
        return CONTIGS if self.options.get("table") == "contigs" else READ_CALLS

    def reader(self, schema):
        return (PushedReader if self.options.get("pushdown") == "true" else BamReader)(self.options)
