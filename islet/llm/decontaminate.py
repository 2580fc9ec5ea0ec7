"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NullType

from islet.llm import textarrays
from islet.llm.common import enter, keep, leave
from islet.llm.textarrays import U, mix

WALKS, BANDS, BITS = 4, 16, 4
SEED = 3  # words
PIECE = 16  # words at most; longer items are looked for by their pieces
_PLAIN = ~np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
HIT = ["item_id", "distance", "item_words", "first_word"]


def words(text: str) -> np.ndarray:
    """Hashes of the lower-cased words; anything in ASCII but letters and digits parts words."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_PLAIN[data]
    turn = np.flatnonzero(np.diff(inside))
    return textarrays.word_hashes(data, turn[0::2], turn[1::2])


def grams(w: np.ndarray, n: int) -> np.ndarray:
    if len(w) < n:
        return np.zeros(0, U)
    total = np.zeros(len(w) - n + 1, U)
    for j in range(n):
        total += w[j : j + len(total)] * U(2 * j * j + 6 * j + 3)
    return mix(total)


def allowed(length: int, part: float) -> int:
    return int(part * length + 1e-9)


def pieces(length: int) -> list[tuple[int, int]]:
    """(start, words) of even pieces of an item and, of longer ones, of those between their middles.

    Walks fall out of step with every edit, so samples of a long item no longer meet; but of its pieces one at least has no more edits a word than
    the whole.
    """
    n = -(-length // PIECE)
    cuts = [i * length // n for i in range(n + 1)]
    middles = [(a + b) // 2 for a, b in zip(cuts, cuts[1:])]
    return [(a, b - a) for some in (cuts, middles) for a, b in zip(some, some[1:])]


def sketch(w: np.ndarray, starts: np.ndarray, lengths: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """LSH keys (windows, WALKS * BANDS) of the windows of ``lengths`` words from ``starts`` on, not beyond ``stops``.

    A walk reads 3 symbols a word, at each step moving on or not by a random bit of the step and the symbol read, so
    that sequences a few edits apart mostly read the same symbols; each band is the hash of the symbols at BITS sampled
    steps of the first two thirds, as after those most walks have passed the end. Windows of all lengths walk together; each length has its own samples.
    """
    out = np.zeros((len(starts), WALKS * BANDS), U)
    for at in range(0, len(starts), 1 << 14):
        cut = slice(at, at + (1 << 14))
        first, size, stop = starts[cut], lengths[cut], stops[cut]
        kinds, kind = np.unique(size, return_inverse=True)
        picks = np.stack([np.random.default_rng(int(n)).integers(0, 2 * n, (WALKS, BANDS, BITS)) for n in kinds])
        rows = np.arange(len(first))
        for walk in range(WALKS):
            i = np.zeros(len(first), np.int64)
            read = np.zeros((3 * int(size.max()), len(first)), U)
            for step in range(len(read)):
                at_word = first + i
                symbol = np.where((i < size) & (at_word < stop), w[np.minimum(at_word, len(w) - 1)], U(0))
                read[step] = symbol
                i += ((mix(symbol + U(step * 977 + walk * 1_000_003 + 1)) >> U(40)) & U(1)).astype(np.int64)
            for band in range(BANDS):
                total = np.full(len(first), walk * BANDS + band + 1, U) * U(0x9E3779B97F4A7C15)
                for k in range(BITS):
                    total += mix(read[picks[kind, walk, band, k], rows] * U(2 * k + 3) + U(k + 1))
                out[cut, walk * BANDS + band] = mix(total)
    return out


def distance(item: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``text``, and where that part starts."""
    row, start = [0] * (len(text) + 1), list(range(len(text) + 1))
    for i, x in enumerate(item, 1):
        last, row[0], was = row[0], i, start[0]
        for j, y in enumerate(text, 1):
            best, at = last + (x != y), was
            last, was = row[j], start[j]
            if row[j] + 1 < best:
                best, at = row[j] + 1, start[j]
            if row[j - 1] + 1 < best:
                best, at = row[j - 1] + 1, start[j - 1]
            row[j], start[j] = best, at
    j = min(range(len(row)), key=row.__getitem__)
    return row[j], start[j]


class Items:
    """A block of benchmark items, ready to be searched for."""

    def __init__(self, rows: list[tuple], part: float, least: int):
        kept = [(i, words(t or "")) for i, t in rows]
        self.items = [(i, w) for i, w in kept if len(w)]
        self.edits = [allowed(len(w), part) if len(w) >= least else 0 for _, w in self.items]
        parts = [(at, a, w[a : a + n]) for at, (_, w) in enumerate(self.items) for a, n in pieces(len(w))]
        self.whole, self.before = (np.array([x[i] for x in parts], np.int64) for i in (0, 1))
        # Within the allowed edits a piece keeps a run of (words - edits) / (edits + 1) words: windows with no SEED-word run of
        # a piece's can't match it; pieces whose runs may be shorter are seeded by what is certain.
        by = defaultdict(list)
        for at, (item, _, w) in enumerate(parts):
            e = min(allowed(len(w), part), self.edits[item])
            n = min(SEED, -(-(len(w) - e) // (e + 1)))
            g = grams(w, n)
            by[n].append((g, np.full(len(g), at), np.arange(len(g))))
        self.seeds = {}
        for n, seeds in by.items():
            g, at, pos = (np.concatenate(x) for x in zip(*seeds))
            order = np.argsort(g, kind="stable")
            flags = np.zeros(1 << 20, bool)
            flags[(g & U((1 << 20) - 1)).astype(np.int64)] = True
            self.seeds[n] = (flags, g[order], at[order], pos[order])
        flat, size = np.concatenate([*[w for *_, w in parts], np.zeros(1, U)]), np.array([len(w) for *_, w in parts], np.int64)
        ends = np.cumsum(size)
        self.sizes, self.keys = size, sketch(flat, ends - size, size, ends)

    def find(self, texts: list[str]) -> list[list[dict]]:
        """The hits of each text."""
        each = [words(t) for t in texts]
        w = np.concatenate([*each, np.zeros(1, U)])
        sizes = np.array([len(x) for x in each], np.int64)
        ends = np.cumsum(sizes)
        wanted = []
        for n, (flags, seeds, item, pos) in self.seeds.items():
            g = grams(w, n)
            some = np.flatnonzero(flags[(g & U((1 << 20) - 1)).astype(np.int64)])
            doc = np.searchsorted(ends, some, "right")
            some, doc = (v[(doc < len(ends)) & (some + n <= ends[np.minimum(doc, len(ends) - 1)])] for v in (some, doc))
            lo, hi = np.searchsorted(seeds, g[some], "left"), np.searchsorted(seeds, g[some], "right")
            times = hi - lo
            k = np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            doc = np.repeat(doc, times)
            begin = np.maximum(np.repeat(some, times) - pos[k], ends[doc] - sizes[doc])
            wanted.append(np.stack([doc, item[k], begin]))
        out = [[] for _ in texts]
        if not wanted:
            return out
        doc, item, start = np.unique(np.concatenate(wanted, 1), axis=1)
        if not len(doc):
            return out
        met = (sketch(w, start, self.sizes[item], ends[doc]) == self.keys[item]).any(1)
        doc, item, start = doc[met], self.whole[item[met]], start[met] - self.before[item[met]]
        doc, item, start = np.unique(np.stack([doc, item, np.maximum(start, ends[doc] - sizes[doc])]), axis=1)
        found: dict[tuple[int, int], tuple] = {}
        upto: dict[tuple[int, int], int] = {}
        for d, k, s in zip(doc.tolist(), item.tolist(), start.tolist()):
            x, begin = self.items[k][1], int(ends[d]) - len(each[d])
            e, s = self.edits[k], s - begin
            if s > upto.get((d, k), -1) and found.get((d, k), (1,))[0]:  # one look covers all starts up to e words on
                lo, upto[d, k] = max(0, s - e), s + e
                least, first = distance(x.tolist(), each[d][lo : s + 2 * e + len(x)].tolist())
                if least <= e and least < found.get((d, k), (e + 1,))[0]:
                    found[d, k] = (least, lo + first)
        for (d, k), (least, first) in found.items():
            out[d].append({"item_id": self.items[k][0], "distance": least, "item_words": len(self.items[k][1]), "first_word": first})
        return out


def find_items(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", max_edits: float = 0.2, min_words: int = 5, block_bytes: int = 4 << 20) -> DataFrame:
    """Adds ``hits``: the benchmark items that a document holds within ``max_edits`` edits a word of the item.

    Each hit has item_id, distance (least word edits to any part of the text), item_words and first_word. Words are
    lower-cased runs of letters and digits. Items are looked for by overlapping pieces of up to PIECE words, one of which has
    no more edits a word than the whole. Windows of a piece's size that share a seed run of words with it (no
    match can lack one) are embedded by CGK random walks and must meet the piece in one of WALKS * BANDS bit samples;
    then the exact edit distance of the whole item decides. The samples find an item at ``max_edits`` in over nine cases of
    ten at every length and for substitutions, insertions and deletions alike (tested from 5 to 400 words), and every exact copy.

    The benchmark goes to the executors in blocks of about ``block_bytes`` of text, one job each, whose broadcast is destroyed
    before the next: neither the driver nor an executor ever holds more than one. Hits of all blocks meet by the hash of the
    text, and then the documents; where they are few, Spark broadcasts them and no document is shuffled.

    Null or empty texts have no hits (an empty array). Of items under ``min_words`` words exact copies are found; items without words never are.
    Repeated rows and items each have their own hits. Texts of other types are cast, ids that aren't whole
    numbers are told as strings, and an input column called hits is replaced.
    """
    spark = docs.sparkSession
    flat, names = enter(docs, text=text)
    flat = flat.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    flat = flat.withColumn("tk", F.xxhash64("text")).withColumn("tl", F.length("text"))
    items, _ = enter(benchmark, item_id=item_id, text=item_text)
    kind = "bigint" if isinstance(items.schema["item_id"].dataType, (IntegralType, NullType)) else "string"
    items = items.select(F.col("item_id").cast(kind).alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    found, told_id = None, pa.int64() if kind == "bigint" else pa.string()
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast([tuple(r) for r in rows.collect()])

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block_items = Items(sent.value, max_edits, min_words)
            for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
                hits = block_items.find(batch.column(2).to_pylist())
                told = [(i, k, *h.values()) for i, each in enumerate(hits) for k, h in enumerate(each)]
                of = pa.array([r[0] for r in told], pa.int64())
                columns = [pa.array([r[j] for r in told], t) for j, t in enumerate((pa.int32(), told_id, pa.int32(), pa.int32(), pa.int32()), 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), *columns], ["tk", "tl", "nth", *HIT])

        # copies of a text tell the same
        told = flat.select("tk", "tl", "text").mapInArrow(run, f"tk long, tl int, nth int, item_id {kind}, distance int, item_words int, first_word int").distinct()
        one = keep(told)
        sent.destroy()
        found = one if found is None else found.union(one)
    met = keep(found.groupBy("tk", "tl").agg(F.array_sort(F.collect_list(F.struct(*HIT))).alias("hits")))
    done = flat.join(met, ["tk", "tl"], "left")
    return leave(done, names, {"hits": F.coalesce("hits", F.array().cast(f"array<struct<item_id:{kind},distance:int,item_words:int,first_word:int>>"))})
