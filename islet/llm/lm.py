"""Cross-entropy difference between matched n-gram models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.llm.common import enter, keep, leave
from islet.llm.textarrays import _LOWER, U, mix, word_bounds, word_hashes

DIRICHLET = 20.0
BATCH = 4 << 20  # bytes of text whose n-grams are asked for together
SEGMENT = 8 << 20  # bytes of text whose n-grams a range of hashes holds on average
START = U(0x2545F4914F6CDD1D)  # stands before the first word
BIGRAM, WORD, TEXTS = range(3)  # the last two bits of a key
SIDES = ("target", "background")
SUMS = (*SIDES, "target_ends", "background_ends")  # how often a key occurs, and how often its word ends a text
TOLD = "batch long, segment int, n int, keys binary, " + ", ".join(f"{c} binary" for c in SUMS)
COUNTED = "batch long, segment int, " + ", ".join(f"{c} binary" for c in SUMS) + ", n_target long, n_background long, n_words long"


def _hashes(text: str) -> np.ndarray:
    data = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    return word_hashes(data, *word_bounds(data))


def _keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the bigrams and the words of all tokens, one kind after the other, then the one of the texts with tokens; and the tokens of each text."""
    each = [_hashes(t) for t in texts]
    size = np.array([len(h) for h in each], np.int64)
    word = np.concatenate([np.zeros(0, U), *each])
    if not len(word):
        return word, size
    before = np.roll(word, 1)
    before[(np.cumsum(size) - size)[size > 0]] = START
    of = lambda x, kind: (x & ~U(3)) | U(kind)
    return np.concatenate([of(mix(mix(before) * U(3) + word), BIGRAM), of(mix(word + U(1)), WORD), of(mix(np.array([START])), TEXTS)]), size


def _shrunk(x: np.ndarray) -> bytes:
    x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T)
    return bytes([x.itemsize]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _grown(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data[1:], n * data[0], codec="zstd"), np.uint8).reshape(data[0], n)
    return np.ascontiguousarray(planes.T).view(f"u{data[0]}").ravel().astype(np.int64)


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys byte by byte of all: the high bytes hardly differ."""
    return pa.compress(np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(pa.decompress(data, n * 8, codec="zstd"), np.uint8).reshape(8, n).T).view(U).ravel()


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tk, tl, text) -> batches of about BATCH bytes of text: their ids, and the rest packed."""
    made, schema = 0, None

    def bundle(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        nonlocal made
        table = pa.Table.from_batches(rows).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema.remove(0), options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table.drop_columns([table.schema.names[0]]))
        made += 1
        ids = pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), table.column(0).combine_chunks() if table.column(0).num_chunks != 1 else table.column(0).chunk(0))
        batch = (TaskContext.get().partitionId() << 32) + made
        return pa.RecordBatch.from_arrays([pa.array([batch]), ids, pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["batch", "ids", "texts"])

    rows, size = [], 0
    for batch in batches:
        ends = np.cumsum([len(t) + 64 for t in batch.column(3).to_pylist()], dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            upto = min(batch.num_rows, int(np.searchsorted(ends, done + BATCH - size)) + 1)
            rows.append(batch.slice(at, upto - at))
            size += int(ends[upto - 1]) - done
            at = upto
            if size >= BATCH:
                yield bundle(rows)
                rows, size = [], 0
    if rows:
        yield bundle(rows)


def _opened(texts: bytes) -> pa.Table:
    return pa.ipc.open_stream(texts).read_all()


def _told(bits: int):
    """(batch, places of its target texts, texts) -> per segment the batch's distinct keys in order and how often target and background have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for batch, places, texts in zip(*[c.to_pylist() for c in rows.columns]):
                keys, size = _keys(_opened(texts).column(2).to_pylist())
                if not len(keys):
                    continue
                target = np.zeros(len(size))
                target[places or []] = 1
                key, at = np.unique(keys, return_inverse=True)
                each = (target, np.ones(len(size)))
                counts = [np.bincount(at, np.concatenate([np.tile(np.repeat(w, size), 2), [w[size > 0].sum()]])).astype(np.int64) for w in each]
                last = at[size.sum() + np.cumsum(size)[size > 0] - 1]  # the places of the texts' last words
                counts += [np.bincount(last, w[size > 0], len(key)).astype(np.int64) for w in each]
                segment = (key >> U(64 - bits)).astype(np.int64)
                cuts = [*np.flatnonzero(np.diff(segment, prepend=-1)).tolist(), len(key)]
                out = [(batch, int(segment[i]), j - i, _packed(key[i:j]), *[_shrunk(c[i:j]) for c in counts]) for i, j in zip(cuts, cuts[1:])]
                kinds = (pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["batch", "segment", "n", "keys", *SUMS])

    return run


def _counted(group: pa.Table) -> pa.Table:
    """All that was told of one segment -> the sums, for each batch in the order of its keys, and once the segment's tokens and words."""
    batch, segment, n, keys, *told = [c.to_pylist() for c in group.columns]
    key, at = np.unique(np.concatenate([_unpacked(k, m) for k, m in zip(keys, n)]), return_inverse=True)
    sums = [np.bincount(at, np.concatenate([_grown(c, m) for c, m in zip(column, n)])).astype(np.int64) for column in told]
    ends = np.cumsum(n)
    back = [pa.array([_shrunk(s[at[e - m : e]]) for e, m in zip(ends, n)], pa.binary()) for s in sums]
    words = (key & U(3)) == WORD
    once = [pa.array([int(x), *[0] * (len(n) - 1)], pa.int64()) for x in (sums[0][words].sum(), sums[1][words].sum(), words.sum())]
    return pa.Table.from_arrays([pa.array(batch, pa.int64()), pa.array(segment, pa.int32()), *back, *once], ["batch", "segment", *SUMS, "n_target", "n_background", "n_words"])


def losses(counts: np.ndarray, ends: np.ndarray, size: np.ndarray, tokens: int, words: int) -> np.ndarray:
    """Of each token, by a model's counts of the keys: Dirichlet-smoothed bigrams over add-one unigrams.

    A word is a context as often as it occurs but doesn't end a text.
    """
    bigram, word = counts[:-1].reshape(2, -1)
    context = np.roll(word - ends[len(word) : -1], 1)
    context[(np.cumsum(size) - size)[size > 0]] = counts[-1]
    return -np.log((bigram + DIRICHLET * (word + 1) / (tokens + words)) / (context + DIRICHLET))


def _scored(tokens: tuple[int, int], words: int):
    """A batch's texts and the sums of its keys by segment -> the mean losses of each text."""

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["segment"])  # the texts are segment -1
        table = _opened(rows[0]["target"])
        keys, size = _keys(table.column(2).to_pylist())
        key, at = np.unique(keys, return_inverse=True)
        n = np.bincount(np.searchsorted([r["segment"] for r in rows], (key >> U(64 - rows[0]["bits"])).astype(np.int64)), minlength=len(rows))
        owner, out = np.repeat(np.arange(len(size)), size), []
        for side, total in zip(SIDES, tokens):
            counts, ends = (np.concatenate([np.zeros(0, np.int64), *[_grown(r[c], int(m)) for r, m in zip(rows[1:], n[1:])]]) for c in (side, f"{side}_ends"))
            sums = np.bincount(owner, losses(counts[at], ends[at], size, total, words), len(size)) if len(key) else np.zeros(len(size))
            out.append(pa.array(sums / np.maximum(size, 1), pa.float64(), mask=size == 0))
        return pa.Table.from_arrays([table.column(0), table.column(1), pa.array(size), *out], ["tk", "tl", "n_tokens", "loss_target", "loss_background"])

    return run


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """Adds n_tokens, loss_target and loss_background (mean loss a token, in nats) and score, target less background: lower is more like the target.

    The background model counts every document, the target model every document with a label of quality 1 that isn't toxic; both
    keep every word and bigram that occurs, over the one vocabulary of all documents' words. Counts are tables by key (a
    64-bit hash): batches of texts are packed, each tells its distinct keys and their counts to the segments of the key
    space, as many as the input needs, and gets the sums back; a key is told once a batch, however common it is.

    Words are the runs of anything but ASCII blanks, A-Z lower-cased. Null and empty texts
    have no tokens and null losses and score. Labels without a document, null labels and repeated ones change nothing;
    without any target document the target model is uniform. Repeated rows each come back, and count each in the models. Input columns named like
    an added column are replaced.
    """
    flat, names = enter(docs, doc_id=doc_id, text=text)
    good, _ = enter(labels, label_id=label_id, quality=quality, toxic=toxic)
    good = good.where("quality = 1 AND coalesce(toxic, 0) = 0").select(F.col("label_id").alias("doc_id")).distinct()
    flat = flat.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    flat = flat.withColumn("tk", F.xxhash64("text")).withColumn("tl", F.length("text"))
    ready = flat.select("doc_id", "tk", "tl", "text")
    size = ready.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(4, (size // SEGMENT).bit_length())
    bundles = keep(ready.mapInArrow(_bundles, f"batch long, ids array<{ready.schema['doc_id'].dataType.simpleString()}>, texts binary"))
    # merged at every size: labels are a third of the documents, so they outgrow any broadcast
    places = bundles.select("batch", F.posexplode("ids").alias("place", "doc_id")).join(good.hint("merge"), "doc_id", "left_semi")
    places = places.groupBy("batch").agg(F.collect_list("place").alias("places"))
    told = bundles.join(places.hint("merge"), "batch", "left").select("batch", "places", "texts").mapInArrow(_told(bits), TOLD)
    counted = keep(told.groupBy("segment").applyInArrow(_counted, COUNTED))
    total = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_target", "n_background", "n_words")]).first()
    own = bundles.select("batch", F.lit(-1).alias("segment"), F.col("texts").alias("target"), *[F.lit(None).cast("binary").alias(c) for c in SUMS[1:]])
    both = own.unionByName(counted.select("batch", "segment", *SUMS)).withColumn("bits", F.lit(bits))
    scored = both.groupBy("batch").applyInArrow(_scored((total.n_target, total.n_background), total.n_words), "tk long, tl int, n_tokens long, loss_target double, loss_background double")
    added = ("n_tokens", "loss_target", "loss_background")
    # written, so that the join below has a shuffle of its own, which adaptive execution can split where a text has many copies
    scored = keep(scored.groupBy("tk", "tl").agg(*[F.min(c).alias(c) for c in added]))
    done = flat.join(scored.hint("merge"), ["tk", "tl"])
    return leave(done, names, {n: F.col(n) for n in added} | {"score": F.col("loss_target") - F.col("loss_background")})
