"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from islet.llm.common import GAP, WORD, enter, keep, leave

AXES = ("source", "lang", "topic")


def form_topic(text: Column, n_tokens: Column) -> Column:
    """A coarse topic from the text's form, where the table has none."""
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>{}=]+", ""))
    return F.when(n_tokens == 0, "empty").when(50 * symbols > F.length(text), "markup").when(n_tokens < 50, "note").when(n_tokens < 600, "article").otherwise("long read")


def tempered_targets(cells: DataFrame, axis: str, power: float) -> DataFrame:
    """(axis, share): each value's tokens to ``power``, as shares of all; under 1 flattens."""
    sums = cells.groupBy(axis).agg(F.sum("tokens").alias("t")).select(axis, F.pow("t", F.lit(power)).alias("p"))
    total = sums.agg(F.sum("p")).first()[0]
    return sums.select(axis, (F.col("p") / F.lit(total)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], *, rounds: int = 60, tolerance: float = 1e-5) -> DataFrame:
    """Adds ``w``, the cells' shares of weight fitted to the marginals, which start as their shares of tokens, and ``off``, how far from 1 the last scale of a cell was.

    Each round scales the weights to one axis after another, by sums per value and a join; a value without a target, or
    a target without cells, has no weight. Ends when every marginal is within ``tolerance`` of its target; after ``rounds`` without that, as when targets
    contradict the cells that there are, it warns of what was reached. The
    cells stay a table, so their number doesn't matter; every round is written to the shared checkpoint folder.
    """
    wanted = {a: t.select(F.col(a), F.col("share")) for a, t in targets.items()}
    now = cells.withColumn("w", F.col("tokens").cast("double"))
    worst = None
    for _ in range(rounds):
        now, off = now.drop("off"), F.lit(0.0)
        for axis, target in wanted.items():
            have = now.groupBy(axis).agg(F.sum("w").alias("have")).join(target, axis, "left").select(axis, F.when(F.col("have") > 0, F.coalesce("share", F.lit(0.0)) / F.col("have")).otherwise(0.0).alias("scale"))
            now = now.join(have, axis).withColumn("w", F.col("w") * F.col("scale")).withColumn(f"off_{axis}", F.abs(F.col("scale") - 1)).drop("scale")
            off = F.greatest(off, F.when(F.col("w") > 0, F.col(f"off_{axis}")).otherwise(0.0))
        now = keep(now.withColumn("off", off).drop(*[f"off_{a}" for a in wanted]))
        worst = now.agg(F.max("off")).first()[0]
        if worst is None or worst < tolerance:
            break
    else:
        warnings.warn(f"raking ended {worst:.2g} off its targets after {rounds} rounds", stacklevel=2)
    return now


def _scale(cells: DataFrame, budget: float) -> float:
    """s such that the expected tokens, at min(1, s * w / tokens) a cell, are the budget (or all there are)."""
    capped, scale = -1, 0.0
    while True:
        over = F.lit(scale) * F.col("w") >= F.col("tokens")
        full, rest, n = cells.where("w > 0 AND tokens > 0").agg(F.sum(F.when(over, F.col("tokens")).otherwise(0)), F.sum(F.when(over, 0.0).otherwise(F.col("w"))), F.count(F.when(over, 1))).first()
        if n == capped or not rest:
            return scale
        capped, scale = n, max(scale, (budget - full) / rest)


def mix_to_targets(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: str = "topic",
    targets: dict[str, DataFrame] | None = None,
    powers: tuple[float, float, float] = (0.5, 0.7, 0.7),
    fraction: float = 0.5,
    seed: int = 17,
) -> DataFrame:
    """Adds n_tokens, mix_topic, weight, probability and sampled.

    Token weights of the cells (source, language, topic) are raked to the marginals in ``targets`` (axis -> table of value and
    share); without them, to the tokens of each value to ``powers``. Each document of a cell has the probability that makes
    the expected tokens the raked share of ``fraction`` of all tokens, at most 1; what cells can't give goes to the others. A
    document is sampled when the hash of its id and ``seed`` falls below its probability, so the sample is the same each time.

    Null sources and languages are values of their own; a null or missing topic is the text's form. Null and empty texts have
    no tokens, weight 0, and are never sampled. Equal ids share their draw; a null id draws by the text. Repeated rows each
    count and come back. Input columns named like an added column are replaced; an empty table gives an empty table.
    """
    flat, names = enter(docs, doc_id=doc_id, text=text, source=source, lang=lang, topic=topic)
    flat = flat.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn("n_tokens", F.when(F.col("text").rlike(WORD), F.size(F.array_remove(F.split("text", GAP), ""))).otherwise(0).cast("long"))
    null = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    flat = flat.withColumn("source", null("source")).withColumn("lang", null("lang"))
    flat = flat.withColumn("mix_topic", F.coalesce(F.col("topic").cast("string"), form_topic(F.col("text"), F.col("n_tokens")))).withColumn("topic", F.concat(F.lit("="), "mix_topic"))
    cells = keep(flat.groupBy(*AXES).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"))
    wanted = {a: tempered_targets(cells, a, p) for a, p in zip(AXES, powers)}
    for a, t in (targets or {}).items():
        wanted[a] = t.select(F.coalesce(F.concat(F.lit("="), F.col(t.columns[0]).cast("string")), F.lit("null")).alias(a), F.col(t.columns[1]).cast("double").alias("share"))
    raked = keep(rake(cells, wanted))
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    scale = _scale(raked, fraction * total)
    rate = raked.select(*AXES, "w", F.least(F.lit(1.0), F.lit(scale) * F.col("w") / F.col("tokens")).alias("p"))
    draw = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), "text")))
    uniform = F.shiftrightunsigned(draw, 11).cast("double") / F.lit(float(1 << 53))
    done = flat.withColumn("u", uniform).join(rate, list(AXES), "left")
    alive = (F.col("n_tokens") > 0) & F.col("w").isNotNull()
    probability = F.when(alive, F.col("p")).otherwise(0.0)
    return leave(
        done,
        names,
        {"n_tokens": F.col("n_tokens"), "mix_topic": F.col("mix_topic"), "weight": F.when(alive, F.col("w")).otherwise(0.0), "probability": probability, "sampled": F.col("u") < probability},
    )
