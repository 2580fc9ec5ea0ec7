"""Removal of byte strings that an earlier document holds: depth-limited radix sort of the suffixes that can match."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from islet.llm.bundles import bundles, opened
from islet.llm.common import enter, keep, leave
from islet.llm.textarrays import U, mix, powers

DEPTH = 50  # bytes
GRAM = 24  # bytes of an anchor
BATCH = 3 << 20  # bytes of text that are looked at together
OFTEN = 32  # batches; of anchors in as many, windows are asked for one by one
MOST = 1 << 14  # buckets of the table of texts and partitions of pieces, at most: beyond, each holds more batches and pieces
_PICKS = DEPTH - GRAM + 1
_BASE = 0x2545F4914F6CDD1D
_INV = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 18
_POS = U((1 << 20) - 1)
ALONE, AGAIN, COMMON = range(3)  # what is answered for a hash: in one document, in several, in OFTEN batches or more
ROWS = "batch long, level int, part int, data binary, places array<int>"
CHOSEN, ANCHORS, WINDOWS = range(3)  # levels of ROWS


def string_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each string of ``size`` bytes."""
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * powers(_BASE, len(data)), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * powers(_INV, len(sums) - size))


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of windows of DEPTH bytes by the anchor they choose: (44-bit anchor hash, first window, windows).

    ``data`` are documents one after the other, which end at ``ends``; no window crosses an end. A window's anchor is its
    GRAM-byte string of least hash, the leftmost of equals: equal windows have equal anchors, wherever they stand, and
    neighbouring windows mostly share one.
    """
    hashes, firsts, counts = [np.zeros(0, U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, max(0, len(data) - DEPTH + 1), _CHUNK):
        gram = string_hashes(data[at : at + _CHUNK + DEPTH - 1], GRAM)
        least = (gram & ~_POS) | np.arange(len(gram), dtype=U)
        span = 1
        while 2 * span <= _PICKS:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[: len(least) - (_PICKS - span)], least[_PICKS - span :])
        # windows that cross an end begin up to DEPTH - 1 bytes before it
        near = ends[np.searchsorted(ends, at, "right") : np.searchsorted(ends, at + len(least) + DEPTH, "left")] - at
        edge = np.zeros(len(least) + 1, np.int32)
        np.add.at(edge, np.clip(near - DEPTH + 1, 0, len(least)), 1)
        np.add.at(edge, np.minimum(near, len(least)), -1)
        ok = np.cumsum(edge[:-1]) == 0
        first = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (ok[1:] != ok[:-1])]))
        n = np.diff(np.append(first, len(least)))
        some = ok[first]
        # least hashes are small ones: mixed again, they are even over the hash space
        hashes.append(mix(least[first[some]] & ~_POS) >> U(20))
        firsts.append(first[some] + at)
        counts.append(n[some])
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(counts)


def _spread(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """first, first + 1, ... of each run of n, and which run it is of."""
    owner = np.repeat(np.arange(len(n)), n)
    return first[owner] + np.arange(len(owner)) - (np.cumsum(n) - n)[owner], owner


def _window_hashes(data: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """44-bit hashes of the windows that start at ``windows``, which are sorted."""
    out = [np.zeros(0, U)]
    for at in range(0, len(data), _CHUNK):
        here = windows[np.searchsorted(windows, at) : np.searchsorted(windows, at + _CHUNK)]
        if len(here):
            out.append(string_hashes(data[at : at + _CHUNK + DEPTH - 1], DEPTH)[here - at] >> U(20))
    return np.concatenate(out)


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes * U(parts)) >> U(44)).astype(np.int64) if parts < 1 << 20 else ((hashes >> U(12)) * U(parts) >> U(32)).astype(np.int64)


def _split(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(key, its slice) of sorted keys."""
    edge = np.flatnonzero(np.diff(keys)) + 1
    for a, b in zip(np.concatenate([[0], edge]), np.concatenate([edge, [len(keys)]])):
        if b > a:
            yield int(keys[a]), slice(int(a), int(b))


class Batch:
    """The chosen texts of a batch one after the other, their anchors, and the answers that it got."""

    def __init__(self, bundle: pa.Table, told: pa.Table):
        rows = sorted(told.to_pylist(), key=lambda r: (r["level"], r["part"]))
        self.batch = bundle.column("batch")[0].as_py() if len(bundle) else None
        places = next((r["places"] for r in rows if r["level"] == CHOSEN), [])
        open_up = lambda data: np.frombuffer(pa.decompress(data[4:], int.from_bytes(data[:4], "little"), "zstd"), np.uint8)
        self.answers = {level: np.concatenate([np.zeros(0, np.uint8), *[open_up(r["data"]) for r in rows if r["level"] == level]]) for level in (ANCHORS, WINDOWS)}
        self.row = self.d = self.ends = np.zeros(0, np.int64)
        self.data = np.zeros(0, np.uint8)
        if places:
            table = opened(bundle.column("texts")[0].as_py()).take(pa.array(sorted(places), pa.int64())).combine_chunks()
            self.row, self.d = (table.column(i).to_numpy() for i in (0, 1))
            text = table.column(2).chunk(0).cast(pa.large_binary())
            off = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            self.data, self.ends = np.frombuffer(text.buffers()[2], np.uint8)[off[0] : off[-1]], off[1:] - off[0]
        self.hash, self.first, self.n = anchors(self.data, self.ends)

    def doc(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, "right")

    def common(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows around common anchors, whose run each is of, and their hashes."""
        status = self.answers[ANCHORS][np.unique(self.hash, return_inverse=True)[1]] if len(self.hash) else np.zeros(0, np.uint8)
        some = np.flatnonzero(status == COMMON)
        windows, owner = _spread(self.first[some], self.n[some])
        return windows, some[owner], _window_hashes(self.data, windows)


def _asked(parts: int, level: int):
    """A batch -> per part of the hash space: the hashes that it asks for in order (low 32 bits), and which of them several of its documents have."""

    def run(bundle: pa.Table, told: pa.Table) -> pa.Table:
        batch = Batch(bundle, told)
        if level == ANCHORS:
            h, doc = batch.hash, batch.doc(batch.first)
        else:
            windows, _, h = batch.common()
            doc = batch.doc(windows)
        order = np.argsort(h, kind="stable")  # documents stay in order
        h, doc = h[order], doc[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]
        many = np.zeros(int(new.sum()), bool)
        many[(np.cumsum(new) - 1)[1:][~new[1:] & (doc[1:] != doc[:-1])]] = True
        key = h[new]
        out = [(p, (key[s] & U(0xFFFFFFFF)).astype(np.uint32).tobytes(), np.packbits(many[s]).tobytes()) for p, s in _split(_part(key, parts))]
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))]
        return pa.Table.from_arrays([pa.array([batch.batch] * len(out), pa.int64()), *columns], ["batch", "part", "low", "many"])

    return run


def _answered(level: int):
    """All that is asked of one part -> for each batch, in the order of what it asked: ALONE, AGAIN or COMMON."""

    def run(group: pa.Table) -> pa.Table:
        batch, part, low, many = [c.to_pylist() for c in group.columns]
        n = np.array([len(x) // 4 for x in low])
        key, at, times = np.unique(np.frombuffer(b"".join(low), np.uint32), return_inverse=True, return_counts=True)
        several = np.zeros(len(key), bool)
        several[at[np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=k) for m, k in zip(many, n)]).astype(bool)]] = True
        status = np.where(times >= OFTEN, COMMON, np.where((times > 1) | several, AGAIN, ALONE)).astype(np.uint8)[at]
        data = [int(k).to_bytes(4, "little") + pa.compress(status[e - k : e].tobytes(), "zstd", asbytes=True) for e, k in zip(np.cumsum(n), n)]
        return pa.Table.from_arrays([pa.array(batch, pa.int64()), pa.array([level] * len(n), pa.int32()), pa.array(part, pa.int32()), pa.array(data, pa.binary()), pa.nulls(len(n), pa.list_(pa.int32()))], ["batch", "level", "part", "data", "places"])

    return run


def radix_groups(data: np.ndarray, at: np.ndarray, size: np.ndarray, *lead: np.ndarray) -> np.ndarray:
    """Group numbers of the strings of ``size`` bytes at ``at`` that are equal to another; -1 for what is alone.

    Most-significant digits first: ``lead`` (what equal strings have equal), the size, then 8 bytes at a time; strings
    alone in their group after a digit are done.
    """
    digits = np.ndarray((len(data) + 1,), ">u8", np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))
    out = np.full(len(at), -1, np.int64)
    live, group = np.arange(len(at)), np.zeros(len(at), np.int64)

    def parted(digit: np.ndarray) -> None:
        nonlocal live, group
        order = np.lexsort((digit, group))
        live, group, digit = live[order], group[order], digit[order]
        new = np.ones(len(live), bool)
        new[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
        group = np.cumsum(new) - 1
        some = np.bincount(group, minlength=1)[group] > 1 if len(group) else new
        live, group = live[some], group[some]

    for first in (*lead, size):
        parted(first[live])
    for depth in range(0, int(size.max(initial=0)), 8):
        left = np.clip(size[live] - depth, 0, 8)
        digit = digits[np.minimum(at[live] + depth, len(data))].astype(U) >> (U(8) * (8 - left).astype(U)) % U(64)
        digit[left == 0] = 0
        parted(digit)
    out[live] = group
    return out


def _runs(pieces: int):
    """A batch -> the runs of windows around anchors that others have, by piece of the hash space; a piece of -1 is removed already.

    Of runs that the batch's own sort finds equal, those of the smallest document go on; the others are removed. Of runs around a common
    anchor only the windows that others have are left.
    """

    def run(bundle: pa.Table, told: pa.Table) -> pa.Table:
        b = Batch(bundle, told)
        status = b.answers[ANCHORS][np.unique(b.hash, return_inverse=True)[1]] if len(b.hash) else np.zeros(0, np.uint8)
        windows, owner, h = b.common()
        if len(windows):
            alive = b.answers[WINDOWS][np.unique(h, return_inverse=True)[1]] != ALONE
            windows, owner = windows[alive], owner[alive]
        new = np.concatenate([[True], (np.diff(windows) != 1) | (np.diff(owner) != 0)])[: len(windows)]
        plain = status == AGAIN
        hashes = np.concatenate([b.hash[plain], b.hash[owner[new]]])
        at = np.concatenate([b.first[plain], windows[new]])
        size = np.concatenate([b.n[plain], np.diff(np.append(np.flatnonzero(new), len(windows)))]) + DEPTH - 1
        doc = b.doc(at)
        start = at - np.append(0, b.ends)[doc]
        equal = radix_groups(b.data, at, size, hashes)
        low = np.full(equal.max(initial=-1) + 1, np.iinfo(np.int64).max)
        some = equal >= 0
        np.minimum.at(low, equal[some], b.d[doc[some]])
        lost = np.zeros(len(at), bool)
        lost[some] = b.d[doc[some]] > low[equal[some]]
        out = []
        if lost.any():
            out.append((-1, b"", b"", b.row[doc[lost]].tobytes(), start[lost].astype(np.int32).tobytes(), size[lost].astype(np.uint16).tobytes(), b""))
        order = np.flatnonzero(~lost)
        part = _part(hashes[order], pieces)
        by = np.argsort(part, kind="stable")
        order = order[by]
        for p, s in _split(part[by]):
            o = order[s]
            text = b.data[_spread(at[o], size[o])[0]].tobytes()
            out.append((p, (hashes[o] & U(0xFFFFFFFF)).astype(np.uint32).tobytes(), b.d[doc[o]].tobytes(), b.row[doc[o]].tobytes(), start[o].astype(np.int32).tobytes(), size[o].astype(np.uint16).tobytes(), text))
        return pa.Table.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), *[pa.binary()] * 6))], RUNS)

    return run


RUNS = ["piece", "hash", "d", "row", "start", "size", "data"]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """The rows of each value of the first column; they come sorted by it."""
    rows, at = [], None
    for batch in (b.slice(i, 64) for b in batches for i in range(0, b.num_rows, 64)):
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if rows and (row[0] != at or at < 0):  # what is removed already needs no whole view
                yield rows
                rows = []
            at = row[0]
            rows.append(row)
    if rows:
        yield rows


def _lost(h: np.ndarray, d: np.ndarray, size: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of whole anchors' runs of windows, which lie in ``data`` one after the other: (run, from, to) of the windows that a smaller document has."""
    at = np.cumsum(size) - size
    equal = radix_groups(data, at, size, h)
    alone = np.flatnonzero(equal < 0)
    equal[alone] = equal.max(initial=-1) + 1 + np.arange(len(alone))
    one, of = np.unique(equal, return_index=True, return_inverse=True)[1:]  # the place of each distinct run
    low = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(low, of, d)
    # distinct runs of one anchor may share windows; those with an anchor of their own can't
    _, anchor, times = np.unique(h[one], return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(times[anchor] > 1)
    n = size[one] - DEPTH + 1
    base = np.cumsum(n) - n
    least = np.repeat(low, n)
    if len(mixed):
        window, owner = _spread(base[mixed], n[mixed])
        places = _spread(at[one[mixed]], n[mixed])[0]
        group = radix_groups(data, places, np.full(len(places), DEPTH), h[one[mixed]][owner])
        some = group >= 0
        if some.any():
            best = np.full(group.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(best, group[some], least[window[some]])
            least[window[some]] = best[group[some]]
    window, owner = _spread(base[of], n[of])
    hit = d[owner] > least[window]
    within = window - base[of][owner]
    # a run of hits ends where its owner does
    first = np.flatnonzero(hit & ~(np.concatenate([[False], hit[:-1]]) & (within > 0)))
    last = np.flatnonzero(hit & ~(np.concatenate([hit[1:], [False]]) & (within < n[of][owner] - 1)))
    return owner[first], within[first], within[last]


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a piece's runs of windows: the removed byte ranges (row, s, e). Whole anchors at a time, some CHUNK bytes of them."""
    for rows in _grouped(batches):
        h, d, row, start, size = (np.concatenate([np.frombuffer(r[i], t) for r in rows]) for i, t in ((1, np.uint32), (2, np.int64), (3, np.int64), (4, np.int32), (5, np.uint16)))
        start, size = start.astype(np.int64), size.astype(np.int64)
        if rows[0][0] < 0:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (row, start, start + size)], ["row", "s", "e"])
            continue
        data = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
        del rows
        at, order = np.cumsum(size) - size, np.argsort(h, kind="stable")
        ends = np.cumsum(size[order])
        last = np.append(np.flatnonzero(np.diff(h[order])) + 1, len(h))  # each anchor's end in the order
        begin = 0
        while begin < len(h):
            upto = int(last[np.searchsorted(last, np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _CHUNK) + 1).clip(max=len(last) - 1)])
            o = order[begin:upto]
            run, a, b = _lost(h[o], d[o], size[o], data[_spread(at[o], size[o])[0]])
            o = o[run]
            yield pa.RecordBatch.from_arrays([pa.array(row[o]), pa.array(start[o] + a), pa.array(start[o] + b + DEPTH)], ["row", "s", "e"])
            begin = upto


def _cut(text_column: str):
    """(input columns, text, whether an earlier text is equal, sorted spans) -> (input columns, n_bytes, n_removed, n_spans, kept)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            out = []
            for text, later, found in zip(batch.column(text_column).to_pylist(), batch.column("later").to_pylist(), batch.column("spans")):
                data = (text or "").encode("utf-8", "surrogatepass")
                if later:
                    out.append((len(data), len(data), 1, b""))
                elif not found.is_valid:
                    out.append((len(data), 0, 0, data))
                else:
                    s, e = (np.asarray(found.values.field(i)) for i in (0, 1))
                    top = np.maximum.accumulate(e)
                    new = np.concatenate([[True], s[1:] > top[:-1]])
                    s, e = s[new], np.append(top[np.flatnonzero(new)[1:] - 1], top[-1])
                    at, kept = 0, []
                    for a, b in zip(s.tolist(), e.tolist()):
                        kept.append(data[at:a])
                        at = b
                    out.append((len(data), int((e - s).sum()), len(s), b"".join([*kept, data[at:]])))
            more = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            own = [i for i, n in enumerate(batch.schema.names) if n.startswith("in_")]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in own], *more], [*[batch.schema.names[i] for i in own], "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Removes each byte covered by a 50-byte string that also starts in a document with a smaller doc_id.

    Texts are whole and taken as UTF-8 bytes; matches never cross documents; strings are judged on the input.
    Adds n_bytes, n_removed, n_spans (maximal removed runs) and kept (the remaining bytes, binary).

    1. Of equal texts the smallest id stands for all; later ones lose everything. Texts are packed in batches of BATCH bytes.
    2. Each window of 50 bytes names an anchor inside it. A batch asks for each of its anchors once, however many documents
       have it, and is told whether others have it too. Where an anchor is in OFTEN batches or more, the batch asks on for each of the
       windows around it, so that what is alone at that depth never meets the anchor's many others.
    3. Runs of windows that are left go by their anchor to the pieces of the hash space, after a depth-limited radix
       sort of the batch by most-significant digits has removed what its own smaller documents hold. In each piece the same
       sort orders the runs, and then the suffixes that start in runs of one anchor, dropping what is alone at each
       digit; after 50 bytes equal groups are exactly the repeated windows, and all but the group's smallest
       document lose theirs.

    So an anchor in fewer than OFTEN batches brings at most their bytes to a task, and a common one a batch's distinct repeated windows once
    a batch. Null text is empty. A doc_id is a whole number, or casts to one (others fail). A null doc_id counts as larger than any other, so such rows only lose bytes. Rows of one
    doc_id never take bytes from each other; repeated rows come back each, with equal results. Texts are told apart by 64-bit
    hashes with their lengths, windows by their bytes. Input columns named like an added column are replaced.
    """
    flat, names = enter(docs, doc_id=doc_id, text=text)
    flat = flat.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn("d", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)))
    flat = flat.withColumn("row", F.xxhash64("text", F.length("text"))).withColumn("n_bytes", F.octet_length("text").cast("long"))
    total = flat.agg(F.sum("n_bytes")).first()[0] or 0
    parts, pieces = 8 + total // (8 << 20), 64 + total // (2 << 20)
    packed = bundles(flat.where(F.col("n_bytes") >= DEPTH).select(F.struct("row", "d").alias("id"), "row", "d", "text"), BATCH, min(16 + total // (32 << 20), MOST))
    each = packed.select("batch", F.posexplode("ids").alias("place", "id")).select("batch", "place", "id.row", "id.d")
    least = keep(each.groupBy("row").agg(F.min(F.struct("d", "batch", "place")).alias("best")))
    chosen = least.groupBy("best.batch").agg(F.collect_list("best.place").alias("places"))
    told = keep(chosen.select("batch", F.lit(CHOSEN).alias("level"), F.lit(0).alias("part"), F.lit(None).cast("binary").alias("data"), "places"))
    by_batch = lambda what, schema: packed.select("batch", "texts").groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(what, schema)
    for level in (ANCHORS, WINDOWS):
        asked = by_batch(_asked(parts, level), "batch long, part int, low binary, many binary")
        told = told.union(keep(asked.groupBy("part").applyInArrow(_answered(level), ROWS)))
    runs = by_batch(_runs(pieces), "piece long, hash binary, d binary, row binary, start binary, size binary, data binary")
    salt = F.when(F.col("piece") < 0, F.xxhash64("row")).otherwise(F.lit(0))  # what is removed already is dealt out
    gone = runs.withColumn("salt", salt).repartition(min(pieces, MOST), "piece", "salt").sortWithinPartitions("piece").drop("salt").mapInArrow(_removed, "row long, s long, e long")
    gone = gone.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("spans"))
    # written, so that the join below has a shuffle of its own, which adaptive execution can split where a text has many copies
    told = keep(least.select("row", F.col("best.d").alias("least")).join(gone, "row", "left"))
    own = [c for c in flat.columns if c.startswith("in_")]
    # a text travels once: under its own column, where that is text
    place = f"in_{names.index(text)}" if text in names and flat.schema[f"in_{names.index(text)}"].dataType == T.StringType() else "text"
    told = flat.select(*own, *(["text"] if place == "text" else []), "row", "d").join(told, "row", "left").withColumn("later", F.coalesce(F.col("d") > F.col("least"), F.lit(False)))
    schema = T.StructType([*flat.select(*own).schema.fields, *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept", T.BinaryType())])
    done = told.select(*own, *(["text"] if place == "text" else []), "later", "spans").mapInArrow(_cut(place), schema)
    return leave(done, names, {n: F.col(n) for n in ("n_bytes", "n_removed", "n_spans", "kept")})
