"""Secret scans with multipart credential linking, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from islet.llm.common import enter, join_salted, keep, leave, scanned

#: kind -> (pattern, its capturing group that must be long enough, least length). Fixed values of the query contract.
BASE = {
    "assign": (r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: What a text must have somewhere to hold a match that is long enough: most texts then need no positions.
LONG_ENOUGH = {"access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}
#: Parts too weak to report alone: kind -> (pattern, role it plays in a credential).
WEAK = {
    "access_id": (r"(?<![A-Za-z0-9_])(?:A[A-Z]IA[A-Z0-9]{8,15}|(?:[uU]ser(?:name)?|[lL]ogin|client_id|access_key_id)\x20*[:=]\x20*[A-Za-z0-9@._-]{3,64})|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "id"),
    "secret_part": (r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]{0,39}[0-9])(?=[a-z0-9+/]{0,39}[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])|(?<![0-9a-z])(?=[a-f]{0,15}[0-9])(?=[0-9]{0,15}[a-f])[0-9a-f]{16,23}(?![0-9a-z])", "secret"),
    "endpoint": (r"(?:https?|ftp|s3|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9][A-Za-z0-9.-]*(?::[0-9]{1,5})?", "endpoint"),
}
KINDS = [*BASE, *WEAK]
NONE = "array<struct<s:int,k:int,e:int>>"
CHUNK = 1024  # code points of a piece of a text that is blanked
ROLE = {"assign": "secret", "access": "id", "hex": "secret"} | {k: r for k, (_, r) in WEAK.items()}


def spans(text: Column, kind: str, pattern: str, group: int = 0, least: int = 1) -> Column:
    """Array of (start, kind order, end) of the leftmost non-overlapping matches; code points, end exclusive.

    The pieces between the matches and the matches themselves alternate, so running sums of their
    lengths are the positions; matches whose ``group`` is shorter than ``least`` count as text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    strong = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)
    order = KINDS.index(kind)
    parts = F.zip_with(F.zip_with(found, strong, lambda f, s: F.struct(F.length(f).alias("len"), F.length(s).alias("strong"))), gaps, lambda m, g: F.struct(F.length(g).alias("gap"), m["len"].alias("len"), m["strong"].alias("strong")))
    real = F.filter(parts, lambda x: x["len"].isNotNull())

    def placed(real: Column) -> Column:
        before = scanned(F.transform(real, lambda x: x["gap"] + x["len"]), F.lit(0), lambda a, b: a + b)
        start = lambda x, at: at + x["gap"]
        every = F.zip_with(real, before, lambda x, at: F.when(x["strong"] >= least, F.struct(start(x, at).alias("s"), F.lit(order).alias("k"), (start(x, at) + x["len"]).alias("e"))))
        return F.filter(every, lambda x: x.isNotNull())

    return F.when(text.rlike(LONG_ENOUGH.get(kind, pattern)), F.get(F.transform(F.array(real), placed), F.lit(0))).otherwise(F.from_json(F.lit("[]"), NONE))


def blanked(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with the sorted spans replaced by ``mark``, those that overlap by one.

    The text is cut into pieces of CHUNK code points once; what stays between spans is joined of the pieces that it touches, so time is linear in
    the text and in the spans.
    """
    last = lambda chunks, at: F.floor(at / CHUNK).cast("int")

    def between(chunks: Column, a: Column, b: Column) -> Column:
        first = last(chunks, a)
        return F.substring(F.array_join(F.slice(chunks, first + 1, last(chunks, b - 1) - first + 1), ""), a - first * CHUNK + 1, b - a)

    def cut(x: Column) -> Column:
        chunks, spans, reach = x["chunks"], x["spans"], x["reach"]
        # where a span begins behind all before it: what lies between, and the mark
        pieces = F.zip_with(spans, reach, lambda s, r: F.when(s["s"] > r, F.concat(between(chunks, r, s["s"]), F.lit(mark))).when(s["s"] == r, F.lit(mark)).otherwise(""))
        end = F.greatest(F.try_element_at(reach, F.lit(-1)), F.try_element_at(spans, F.lit(-1))["e"])
        tail = F.when(end < F.length(text), between(chunks, end, F.length(text))).otherwise("")
        return F.concat(F.array_join(pieces, ""), tail)

    reach = scanned(F.transform(found, lambda s: s["e"]), F.lit(0), lambda a, b: F.greatest(a, b))
    whole = F.struct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)).alias("chunks"), found.alias("spans"), reach.alias("reach"))
    return F.when(F.size(found) == 0, text).otherwise(F.get(F.transform(F.array(whole), cut), F.lit(0)))


def joined(found: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(found), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def link_credentials(docs: DataFrame, *, text: str = "text", scope: int = 300) -> DataFrame:
    """Finds secrets in every whole text, and weak parts of credentials where complementary parts co-occur.

    Strong kinds (assign, access, hex) are always reported. Weak kinds - an access identifier (a login, a short key id, an
    e-mail address), a secret-looking run, an endpoint - are reported only when, within ``scope`` code points of text
    between them, the document also holds a complementary part: identifiers need a secret, secrets
    an identifier or an endpoint, endpoints a secret. Weak parts inside a strong span are that span.
    Complements are found by an interval join on (text, scope-wide bin): a part is in every bin that it
    touches, and weak parts also look into the neighbours of theirs.

    Adds base_spans and all_spans (arrays of start, kind order, end), and redacted (the text with every
    reported span replaced by ``[SECRET]``).

    Null text is an empty text, with empty spans. The result depends on the text alone, so equal texts
    and repeated rows get equal spans. Input columns named like an added column are replaced by it.
    """
    flat, names = enter(docs, text=text)
    flat = flat.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    flat = flat.withColumn("tk", F.xxhash64("text")).withColumn("tl", F.length("text"))
    base = F.sort_array(F.concat(*[spans(F.col("text"), k, *how) for k, how in BASE.items()]))
    weak = F.concat(*[spans(F.col("text"), k, pattern) for k, (pattern, _) in WEAK.items()])
    # what patterns find, once a text: neither the parts nor the result look again
    found = flat.select("tk", "tl", base.alias("base_spans"), weak.alias("weak")).where(F.size("weak") + F.size("base_spans") > 0)
    found = keep(found.groupBy("tk", "tl").agg(F.first("base_spans").alias("base_spans"), F.first("weak").alias("weak")))
    parts = found.where(F.size("weak") > 0).where(F.size("weak") + F.size("base_spans") > 1).select("tk", "tl", F.explode(F.concat("base_spans", "weak")).alias("p")).select("tk", "tl", "p.s", "p.k", "p.e").distinct()
    role = F.get(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("k"))
    first, last = F.floor(F.col("s") / scope), F.floor(F.col("e") / scope)
    parts = parts.withColumn("role", role)
    weak = parts.where(F.col("k") >= len(BASE)).withColumn("bin", F.explode(F.sequence(first - F.lit(1), last + F.lit(1))))
    mate = parts.select("tk", "tl", F.explode(F.sequence(first, last)).alias("bin"), F.col("s").alias("ms"), F.col("k").alias("mk"), F.col("e").alias("me"), F.col("role").alias("mrole"))
    fits = ((F.col("role") == "secret") & F.col("mrole").isin("id", "endpoint")) | (F.col("role").isin("id", "endpoint") & (F.col("mrole") == "secret"))
    linked = (
        weak.join(mate, ["tk", "tl", "bin"])
        .withColumn("inside", (F.col("mk") < len(BASE)) & (F.col("ms") < F.col("e")) & (F.col("me") > F.col("s")))
        .where(F.col("inside") | (fits & (F.col("ms") < F.col("e") + scope) & (F.col("me") + scope > F.col("s"))))
        .groupBy("tk", "tl", "s", "k", "e")
        .agg(F.max("inside").alias("inside"))
        .where(~F.col("inside"))
        .groupBy("tk", "tl")
        .agg(F.collect_set(F.struct("s", "k", "e")).alias("more"))
    )
    # written, so that the join below has a shuffle of its own
    told = keep(found.drop("weak").join(linked, ["tk", "tl"], "left"))
    none = F.from_json(F.lit("[]"), NONE)
    done = join_salted(flat, told, ["tk", "tl"], "left").withColumn("base_spans", F.coalesce("base_spans", none))
    every = F.sort_array(F.concat("base_spans", F.coalesce("more", none)))
    done = done.withColumn("all_spans", every)
    redacted = blanked(F.col("text"), F.col("all_spans"))
    return leave(done, names, {"base_spans": F.col("base_spans"), "all_spans": F.col("all_spans"), "redacted": redacted})
