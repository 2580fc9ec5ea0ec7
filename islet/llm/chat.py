"""Chat formatting: collapse of cumulative snapshots, then rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from islet.llm.common import enter, keep


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, h, more): every prefix of every conversation with its rolling hash, and whether the conversation goes on.

    A prefix's hash is the one before it xor the hash of the turn with its place, twice 64 bits, so it rolls on in one pass over
    the sorted turns, however long a conversation is.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turn = F.struct("turn", "role", "text")
    new = turns.withColumn("new", ~F.lag(turn).over(order).eqNullSafe(turn)).where("new").withColumn("n_turns", F.row_number().over(order).cast("long"))
    told = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    one = lambda seed: F.xxhash64(F.lit(seed), "n_turns", told(F.col("role")), told(F.col("text")))
    rolled = new.withColumn("h", F.struct(*[F.bit_xor(one(seed)).over(upto).alias(seed) for seed in ("a", "b")]))
    return rolled.select("conv_id", "n_turns", "h", F.lead("n_turns").over(order).isNotNull().alias("more"))


def collapse_snapshots(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", start: str = "<|{role}|>\n", end: str = "<|end|>\n") -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns and rendered.

    A logged conversation that is a proper prefix of another one (same roles and texts, turn by turn) is a snapshot of it and
    is left out; of equal conversations the one with the smallest id stays. Rolling hashes of the turn prefixes (two
    of 64 bits) find them by an anti-join.

    Turns go by turn number, then role, then text, nulls first; repeated rows of a turn count once. Null roles and texts
    differ from empty ones but render as empty. Turns with a null conv_id belong to no conversation and are left out.
    Any other column is ignored; an empty table gives an empty table.

    Hashes are made over sorted turns in time linear in them; only conversations that stay are put together. What is hot is met pre-aggregated: equal conversations are one row before the anti-join, and a prefix that many
    conversations begin with is one row of its other side.
    """
    flat, _ = enter(turns, conv_id=conv_id, turn=turn, role=role, text=text)
    flat = flat.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).where("conv_id IS NOT NULL")
    rolled = keep(prefixes(flat))
    one = rolled.where("NOT more").groupBy("n_turns", "h").agg(F.min("conv_id").alias("conv_id"))
    kept = one.join(rolled.where("more").select("n_turns", "h").distinct(), ["n_turns", "h"], "left_anti").select("conv_id")
    convs = flat.join(kept, "conv_id").groupBy("conv_id").agg(F.array_sort(F.array_distinct(F.collect_list(F.struct("turn", "role", "text")))).alias("all"))
    before, _, after = start.partition("{role}")
    one_turn = lambda x: F.concat(F.lit(before), F.coalesce(x["role"], F.lit("")), F.lit(after), F.coalesce(x["text"], F.lit("")), F.lit("\n"), F.lit(end))
    return convs.select("conv_id", F.size("all").cast("long").alias("n_turns"), F.array_join(F.transform("all", one_turn), "").alias("rendered"))
