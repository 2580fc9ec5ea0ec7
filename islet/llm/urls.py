"""URL filters: host and path rules, and a character language-model ratio where no rule decides. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from islet.llm.common import enter, keep, leave

ORDER = 4  # characters of context, at most
HELD = 5  # of the ruled URLs one in so many calibrates the threshold and trains nothing
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    pattern = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _LOWER), F.regexp_extract(url, pattern, 2)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; ``rules``: (host/path prefix, allow or block)."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, _, rest = text.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def gram_ratios(grams: DataFrame) -> DataFrame:
    """(gram, ok, bad) -> (gram, ratio): log P_ok - log P_bad of the last character after the ones before it.

    Variable-order Markov models with Witten-Bell smoothing: the probability after a context is interpolated with the one
    after its shorter suffix, down to the even chance of a character; a context never seen leaves it all to the
    shorter one. Both models see the same grams and order. Tables are of distinct grams.
    """
    sides = ("ok", "bad")
    last = None
    for k in range(ORDER + 1):
        level = grams.groupBy(F.substring("gram", ORDER + 1 - k, k + 1).alias("g")).agg(*[F.sum(s).alias(s) for s in sides])
        if k == 0:
            total = level.agg(*[F.sum(s) for s in sides], *[F.count(F.when(F.col(s) > 0, 1)) for s in sides]).first()
            seen = {s: (float(total[i] or 0), float(total[i + 2] or 0)) for i, s in enumerate(sides)}
            last = level.select("g", *[((F.col(s) + F.lit(seen[s][1]) / 256) / F.lit(max(1.0, sum(seen[s])))).alias(f"p_{s}") if sum(seen[s]) else F.lit(1 / 256).alias(f"p_{s}") for s in sides])
            continue
        level = level.withColumn("c", F.substring("g", 1, k)).withColumn("suffix", F.substring("g", 2, k))
        context = level.groupBy("c").agg(*[F.sum(s).alias(f"n_{s}") for s in sides], *[F.count(F.when(F.col(s) > 0, 1)).alias(f"t_{s}") for s in sides])
        below = last.select(F.col("g").alias("suffix"), *[F.col(f"p_{s}").alias(f"b_{s}") for s in sides])
        mixed = lambda s: F.when(F.col(f"n_{s}") > 0, (F.col(s) + F.col(f"t_{s}") * F.col(f"b_{s}")) / (F.col(f"n_{s}") + F.col(f"t_{s}"))).otherwise(F.col(f"b_{s}"))
        last = level.join(context, "c").join(below, "suffix").select("g", *[mixed(s).alias(f"p_{s}") for s in sides])
    return last.select(F.col("g").alias("gram"), (F.log("p_ok") - F.log("p_bad")).alias("ratio"))


def calibrated(scored: DataFrame) -> float | None:
    """The score that parts (label ok or not, score) with the least balanced error; null without both labels.

    Scores go by hundredths; of thresholds with equal error the middle of the gap between two scores that occur.
    """
    bins = scored.where("label IS NOT NULL").groupBy(F.round("score", 2).alias("bin")).agg(F.count(F.when(F.col("label"), 1)).alias("ok"), F.count(F.when(~F.col("label"), 1)).alias("bad"))
    # scores are logs of ratios a character: within +-40, so some thousand bins at most
    rows = sorted(bins.collect(), key=lambda r: r.bin)
    ok, bad = sum(r.ok for r in rows), sum(r.bad for r in rows)
    if not ok or not bad:
        return None
    best, at, lost, kept, below = 2.0, 0.0, 0, bad, rows[0].bin - 0.01
    for r in rows:  # block what is below the middle of the last bin and this one
        error = lost / ok + kept / bad
        if error < best:
            best, at = error, (below + r.bin) / 2
        lost, kept, below = lost + r.ok, kept - r.bad, r.bin
    return at


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], *, url: str = "url") -> DataFrame:
    """Adds host, path, rule, verdict (allow or block) and score.

    The longest fitting rule decides; a rule fits its host and all subdomains where the path starts with its path. URLs
    that no rule fits are judged by their score, the length-normalised log-likelihood ratio of two character models
    of host and path, one of the URLs that rules allow and one of those that they block: below the calibrated
    threshold they are blocked. One in HELD of the ruled names, by a hash of the name, trains neither model; these calibrate the
    threshold. Where the held-out names aren't of both kinds there is no threshold, and the rest is allowed.

    Null URLs and those without ``://`` have an empty host and path, no score, and are allowed. Repeated rows each come
    back and count each in the models. Names are told apart by 64-bit hashes with their lengths. Input columns named like an added column are replaced; an empty table gives an empty table.
    """
    flat, names = enter(pages, url=url)
    host, path = host_path(F.col("url"))
    flat = flat.withColumn("host", host).withColumn("path", path)
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    flat = flat.withColumn("rule", rule).withColumn("ruled", verdict).withColumn("name", F.concat("host", "path"))
    flat = flat.withColumns({"nk": F.xxhash64("name"), "nl": F.length("name")})
    names_of = keep(flat.where("name <> ''").groupBy("nk", "nl", "name", "ruled").agg(F.count("*").alias("n")))
    # the characters once, and each gram of neighbours in their array: linear in a name's length
    chars = F.regexp_extract_all(F.concat(F.lit("\x01" * ORDER), "name", F.lit("\x02")), F.lit("(?s)."), F.lit(0))
    gram = lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - F.lit(ORDER + 1)), lambda i: F.concat(*[F.get(c, i + k) for k in range(ORDER + 1)]))
    cut = F.get(F.transform(F.array(chars), gram), F.lit(0))
    # a name's grams carry its hash and length, which are columns by now, not itself
    places = names_of.select("nk", "nl", "ruled", "n", F.explode(cut).alias("gram"))
    held = F.pmod(F.col("nk"), F.lit(HELD)) == 0
    count = lambda says: F.sum(F.when((F.col("ruled") == says) & ~held, F.col("n")).otherwise(0))
    grams = keep(places.groupBy("gram").agg(count("allow").alias("ok"), count("block").alias("bad")))
    scores = keep(places.join(gram_ratios(grams), "gram").groupBy("nk", "nl", "ruled").agg(F.round(F.avg("ratio"), 9).alias("score")))
    threshold = calibrated(scores.where(held).select((F.col("ruled") == "allow").alias("label"), "score"))
    by_name = scores.groupBy("nk", "nl").agg(F.first("score").alias("score"))
    done = flat.join(by_name, ["nk", "nl"], "left")
    guess = F.lit("allow") if threshold is None else F.when(F.col("score") < F.lit(threshold), "block").otherwise("allow")
    return leave(done, names, {"host": F.col("host"), "path": F.col("path"), "rule": F.col("rule"), "verdict": F.coalesce("ruled", guess), "score": F.col("score")})
