"""Quality rules by cross-document line frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.llm.common import GAP, WORD, enter, keep, leave

LINE_GAP = r"[\x20\x09\x0B-\x0D]+"

#: Sorted (hash, start) windows -> starts of those whose hash occurs again -> words under their union.
_REPEATED = """
CASE WHEN size(array_distinct(win)) = size(win) THEN 0 ELSE
  transform(array(sort_array(transform(win, (h, i) -> struct(h, i)))), s ->
    transform(array(sort_array(transform(
        filter(s, (x, j) -> (j > 0 AND s[greatest(j - 1, 0)].h = x.h) OR (j < size(s) - 1 AND s[least(j + 1, size(s) - 1)].h = x.h)),
        x -> x.i))), p ->
      aggregate(transform(p, (x, j) -> IF(j = size(p) - 1, 8, least(8, p[least(j + 1, size(p) - 1)] - x))), 0, (a, b) -> a + b))[0])[0]
END"""

#: Everything that needs the words, as one expression: each step is bound by a lambda, so a filter that the optimizer pushes
#: down repeats the whole at most once and never its parts within each other.
_METRICS = f"""
transform(array(array_remove(split(text, r'{GAP}'), '')), words ->
  transform(array(transform(words, w -> xxhash64(w))), wh ->
    transform(array(IF(size(wh) >= 8, transform(sequence(0, size(wh) - 8), i -> xxhash64({", ".join(f"wh[i + {k}]" for k in range(8))})), array())), win ->
      transform(array(CAST({_REPEATED} AS BIGINT)), r ->
        struct(CAST(size(words) AS BIGINT) AS n_words, CAST(length(array_join(words, '')) AS BIGINT) AS word_chars, r AS n_repeat_words, size(words) < 20 OR 100 * r > 30 * size(words) AS base_failed))[0])[0])[0])[0]"""
_DUP_LINES = f"""transform(array(filter(split(text, '\\n'), x -> x rlike r'{WORD}')), full -> size(full) - size(array_distinct(full)))[0]"""

#: Lines -> each distinct line's hash and the words in all its occurrences, through a sort of (hash, words).
_COUNTED = """
transform(array(sort_array(transform(lines, x -> struct(xxhash64(x) AS h, length(x) - length(replace(x, ' ', '')) + 1 AS w)))), s ->
  transform(array(filter(transform(s, (x, j) -> IF(j > 0 AND s[greatest(j - 1, 0)].h = x.h, -1, j)), j -> j >= 0)), f ->
    transform(f, (j, k) -> struct(s[j].h AS h, s[j].w * (IF(k + 1 < size(f), f[least(k + 1, size(f) - 1)], size(s)) - j) AS w)))[0])[0]"""


def line_frequency_rules(docs: DataFrame, *, text: str = "text", host: str = "source", max_share: float = 0.01, min_docs: int = 5, copies_count: bool = False, max_removed: float = 0.5) -> DataFrame:
    """Judges every document by simple text rules and by how much of it is boilerplate of its host.

    Lines are normalised (case, inner and outer blanks), hashed, and counted over the
    documents of their host: with ``copies_count`` over all its rows; without, rows of the same text count as one, for
    use before copies are taken out, where a large group of copies would else make all of its own lines frequent. A line found in more than
    ``max_share`` of the host's documents that have lines, and in more than ``min_docs``, is removed; a document that
    loses over ``max_removed`` of its words is depleted and rejected.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words,
    clean_text (the text without the removed lines) and kept.

    Null text is an empty text (no words, so base_failed). Null hosts form one host of their own.
    Repeated rows each come back, with equal verdicts. Input columns named like an added column
    are replaced by it; an empty table gives an empty table.

    Shuffles carry hashes and counts of lines, never texts: lines to (host, line, document), which is written once, then
    counts to (host, line), both pre-aggregated; joins on hot lines are inner or left joins that AQE
    can split.
    """
    flat, names = enter(docs, text=text, host=host)
    base = flat.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn("host", F.col("host").cast("string"))
    base = base.withColumn("tk", F.xxhash64("text")).withColumn("tl", F.length("text"))
    # host can be null: joins use a pair that is never null
    base = base.withColumn("hk", F.coalesce(F.concat(F.lit("="), "host"), F.lit("-")))

    normal = F.split(F.lower(F.regexp_replace("text", LINE_GAP, " ")), "\n")
    # line hash null: the document itself, so that a host's documents are counted like a line of all of them
    itself = F.array(F.struct(F.lit(None).cast("long").alias("h"), F.lit(0).alias("w")))
    lines = keep(
        base.withColumn("lines", F.filter(F.transform(normal, lambda x: F.trim(x)), lambda x: x != ""))
        .where(F.size("lines") > 0)
        .select("hk", "tk", "tl", F.explode(F.concat(F.expr(_COUNTED), itself)).alias("line"))
        # of equal texts one is enough: the map side drops most, this grouping the rest
        .groupBy("hk", F.col("line.h").alias("lh"), "tk", "tl")
        .agg(F.max("line.w").alias("w"), F.count("*").alias("copies"))
    )
    counted = lines.groupBy("hk", "lh").agg(F.sum("copies" if copies_count else F.lit(1)).alias("docs")).where(F.col("lh").isNull() | (F.col("docs") > min_docs))
    hosts = counted.where("lh IS NULL").select("hk", F.col("docs").alias("all"))
    frequent = counted.where("lh IS NOT NULL").join(hosts, "hk").where(F.col("docs") > F.lit(max_share) * F.col("all")).select("hk", "lh")
    # written, so that the join below has a shuffle of its own, which adaptive execution can split where a text has many copies
    hit = keep(lines.join(frequent, ["hk", "lh"]).groupBy("hk", "tk", "tl").agg(F.sum("w").cast("long").alias("lost"), F.collect_set("lh").alias("bad")))

    met = (
        base.withColumn("m", F.expr(_METRICS))
        .withColumn("n_symbols", F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long"))
        .withColumn("n_dup_lines", F.expr(_DUP_LINES).cast("long"))
    )
    judged = met.join(hit, ["hk", "tk", "tl"], "left")
    key = lambda x: F.xxhash64(F.trim(F.lower(F.regexp_replace(x, LINE_GAP, " "))))
    raw = F.split("text", "\n")
    clean = F.when(F.col("bad").isNull(), F.col("text")).otherwise(F.array_join(F.filter(raw, lambda x: ~F.array_contains(F.col("bad"), key(x))), "\n"))
    judged = judged.withColumn("n_removed_words", F.coalesce("lost", F.lit(0).cast("long")))
    told = {n: F.col(f"m.{n}") for n in ("n_words", "word_chars", "n_repeat_words", "base_failed")}
    own = {n: told.get(n, F.col(n)) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words")}
    kept = ~F.col("m.base_failed") & ~(F.col("n_removed_words") > F.lit(max_removed) * F.col("m.n_words"))
    return leave(judged, names, own | {"clean_text": clean, "kept": kept})
