"""Spelling variants: words one edit apart, found in blocks of sorted dictionaries read forward and backward."""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.llm.common import enter, join_salted, keep

#: Letters of a word: what one Latin-1 byte each can hold.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The most words of a block that are compared with each other. Blocks whose words differ in one place alone hold at most the 90 letters and one shorter word.
BLOCK = 128
#: Words of more letters are compared one by one.
WIDE = 64


def _runs(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    flat, _ = enter(docs, text=text, doc_id=doc_id)
    found = F.regexp_extract_all(F.translate(F.col("text").cast("string"), UPPER, LOWER), F.lit(f"({RUN})"), 1)
    return flat.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(found).alias("word"))


def with_typos(runs: DataFrame, one_in: int = 97) -> DataFrame:
    """Deletes a letter of about one run in ``one_in``, by a hash of document and run, so that tests know what is misspelt."""
    h = F.crc32(F.concat_ws(":", "doc_id", "word").cast("binary"))
    at = F.pmod(h, F.length("word")).cast("int")
    cut = F.concat(F.expr("substring(word, 1, at)"), F.expr("substring(word, at + 2, length(word))"))
    return runs.withColumn("at", at).withColumn("word", F.when(h % one_in == 0, cut).otherwise(F.col("word"))).drop("at")


def _split(blocks: DataFrame) -> DataFrame:
    """Both halves of each block's words: one edit in ``rest`` letters leaves the first or the last half of them as it is.

    ``a`` and ``b`` are the letters in front and behind that a block's words share. ``below`` keeps a pair from being found twice: behind
    a choice of the last half, the pair must differ within the first half.
    """
    half = F.expr("(size - a - b) div 2")
    first = F.struct(F.concat("way", F.lit("P")).alias("way"), (F.col("a") + half).cast("int").alias("a"), F.col("b"), F.col("below"))
    last = F.struct(F.concat("way", F.lit("S")).alias("way"), F.col("a"), (F.col("b") + half).cast("int").alias("b"), F.least("below", (F.col("a") + half).cast("int")).alias("below"))
    out = blocks.select("word", "n", "size", F.explode(F.array(first, last)).alias("x")).select("word", "n", "size", "x.*")
    return out.withColumn("key", F.concat_ws("|", F.expr("lpad(size, 9, '0')"), "way", F.expr("left(word, a)"), F.reverse(F.expr("right(word, b)"))))


def _near(words: list[bytes], size: np.ndarray, below: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of the same block whose words are one edit apart; rows come block by block."""
    length = np.array([len(w) for w in words], np.int64)
    width = int(length.max(initial=0)) + 1
    front, back = (np.array(x, f"S{width}").view(np.uint8).reshape(len(words), width) for x in (words, [w[::-1] for w in words]))
    ends = np.flatnonzero(np.append(np.diff(block) != 0, True)) + 1
    end = np.repeat(ends, np.diff(ends, prepend=0))
    found_i, found_j = [], []
    rows = np.arange(len(words))
    for step in itertools.count(1):
        i = rows[rows + step < end]
        if not len(i):
            break
        j = i + step
        la, lb = length[i], length[j]
        some = np.maximum(la, lb) == size[i]
        i, j, la, lb = i[some], j[some], la[some], lb[some]
        # both orders end at a place that differs: behind a word's letters there is a zero, and equal words don't come
        pre = (front[i] != front[j]).argmax(1)
        suf = (back[i] != back[j]).argmax(1)
        good = (pre + suf >= size[i] - 1) & (pre < below[i])
        found_i.append(i[good])
        found_j.append(j[good])
    if not found_i:
        return rows[:0], rows[:0]
    return np.concatenate(found_i), np.concatenate(found_j)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the words of each block; a block that a batch cuts waits for its rest. Gives each word its near words' number and best."""
    held: list[tuple] = []

    def answer(rows: list[tuple]) -> pa.RecordBatch:
        best: dict[bytes, list] = defaultdict(lambda: [0, 0, b""])
        for wide in (False, True):
            some = [r for r in rows if (r[2] > WIDE) == wide]
            # few long words at a time, so that the arrays stay small
            for group in _groups(some, max(BLOCK, (8 << 20) // max([r[2] for r in some], default=1)) if wide else 1 << 16):
                words = [r[0].encode("latin-1") for r in group]
                block = np.cumsum([0] + [x[4] != y[4] for x, y in zip(group, group[1:])])
                size, below = (np.array([r[k] for r in group], np.int64) for k in (2, 3))
                for i, j in zip(*(x.tolist() for x in _near(words, size, below, block))):
                    for a, b in ((i, j), (j, i)):
                        got = best[words[a]]
                        got[0] += 1
                        if (-group[b][1], words[b]) < (-got[1], got[2]):
                            got[1:] = [group[b][1], words[b]]
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in best], pa.string()), pa.array([x[0] for x in best.values()], pa.int64()), pa.array([x[1] for x in best.values()], pa.int64()), pa.array([x[2].decode("latin-1") for x in best.values()], pa.string())],
            names=["word", "n_near", "near_n", "near"],
        )

    for batch in batches:
        held += zip(*(batch.column(c).to_pylist() for c in ("word", "n", "size", "below", "key")))
        at = len(held)
        while at and held[at - 1][4] == held[-1][4]:
            at -= 1
        if at:
            yield answer(held[:at])
            held = held[at:]
    if held:
        yield answer(held)


def _groups(rows: list[tuple], most: int) -> Iterator[list[tuple]]:
    """Pieces of about ``most`` rows that don't cut blocks."""
    at = 0
    while at < len(rows):
        end = min(len(rows), at + most)
        while end < len(rows) and rows[end][4] == rows[end - 1][4]:
            end += 1
        yield rows[at:end]
        at = end


def near_words(words: DataFrame) -> DataFrame:
    """(word string of Latin-1 letters, n long; distinct words) -> word, n_near, near_n, near: how many words are one edit away, and the commonest of them.

    One inserted, deleted or replaced letter leaves the front or the back half of a word as it is. Words with the same front half
    stand together in the sorted dictionary, words with the same back half in the dictionary of reversed words; each such
    block is compared within. A block of more than BLOCK words is divided again, by the halves of the letters its words don't
    share yet, until all are small; words that share all but one place never are more than the alphabet. No pair is found twice.
    """
    sizes = F.explode(F.array(F.length("word"), F.length("word") + 1))
    start = words.select("word", "n", sizes.alias("size"), F.lit("").alias("way"), F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(1 << 30).alias("below"))
    todo, done = keep(_split(start)), None
    while True:
        large = todo.groupBy("key").agg(F.count("*").alias("rows"), F.max(F.col("size") - F.col("a") - F.col("b")).alias("rest")).where((F.col("rows") > BLOCK) & (F.col("rest") > 1)).select("key", F.lit(True).alias("large"))
        if large.isEmpty():
            small, todo = todo, None
        else:
            marked = keep(join_salted(todo, keep(large), ["key"], "left"))
            small, todo = marked.where("large IS NULL").drop("large"), keep(_split(marked.where("large").drop("large")))
        done = small if done is None else done.unionByName(small)
        if todo is None:
            break
    parts = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = done.select("word", "n", "size", "below", "key").repartitionByRange(parts, "key").sortWithinPartitions("key")
    found = ranged.mapInArrow(_scan, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("x")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("x.m")).alias("near_n"), F.col("x.w").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) of the words that have a form -> (word, root): the end of each chain, by doubling the steps each round.

    A form is at least twice as frequent as its word, so chains end, within as many steps as counts can double.
    """
    now = keep(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = keep(join_salted(now, onward, ["root"], "left"))
        now = after.select("word", F.coalesce("next", "root").alias("root"))
        if after.where("next IS NOT NULL").isEmpty():
            return now


def spelling_variants(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", typos: int = 0, min_letters: int = 5, min_count: int = 3, times: int = 2) -> DataFrame:
    """Words of a corpus -> word, n, n_near, form, form_n, root.

    Words are runs of Latin letters (A-Z lower-cased) of at least ``min_letters`` that occur ``min_count`` times or more.
    ``form`` is the commonest word one edit away (ties: the smallest by code points) where it is ``times`` as frequent; ``root`` is
    where following forms ends, the word itself without a form. With ``typos``, one run in so many loses a letter first, by a hash.

    Null texts have no words, a null id counts as an empty one, repeated rows count each time, and an empty table gives an empty result.
    Other columns are not looked at. Runs are counted in the tasks before they are shuffled, so that frequent words don't gather.
    """
    runs = _runs(docs, text, doc_id)
    if typos:
        runs = with_typos(runs, typos)
    counted = runs.groupBy("word").agg(F.count("*").alias("n")).where((F.length("word") >= min_letters) & (F.col("n") >= min_count))
    counted = keep(counted)
    both = counted.join(near_words(counted), "word", "left")
    good = F.col("near_n") >= times * F.col("n")
    both = keep(both.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(good, F.col("near")).alias("form"), F.when(good, F.col("near_n")).alias("form_n")))
    ends = roots(both.where("form IS NOT NULL"))
    return both.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
