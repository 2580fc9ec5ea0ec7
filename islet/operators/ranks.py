"""Order statistics of large groups: the first rows of each, and exact quantiles, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from islet.functions.numeric import null_if_nan, same_rows
from islet.functions.storage import keep


def first_per_group(df: DataFrame, group: Sequence[str], score: Column, ties: Sequence[str], k: int, *, step: float = 1e-3, rank: str = "rank") -> DataFrame:
    """The ``k`` rows of largest score in each group (null last, then by ``ties``, which must break all ties), with their rank from 1.

    Counts per group and bin of ``step`` of the score give each group the lowest bin that its first k rows reach; rows below
    go. Of what is left (k rows and the ties of one bin), parts of a group by a hash of the ties keep k rows each, in fewer and
    fewer parts: the last task of a group sees 16 k rows at most.
    """
    told = df.withColumn("_score", score.cast("double")).withColumn("_bin", F.coalesce(F.floor(F.col("_score") / step), F.lit(-(1 << 62))))
    bins = told.groupBy(*group, "_bin").agg(F.count("*").alias("_n"))
    above = F.sum("_n").over(Window.partitionBy(*group).orderBy(F.desc("_bin"))) - F.col("_n")
    reach = bins.withColumn("_above", above).where(F.col("_above") < k).groupBy(*group).agg(F.min("_bin").alias("_least"))
    rows = told.alias("a").join(reach.alias("b"), same_rows("a", "b", group)).where("a._bin >= b._least").select("a.*")
    order = [F.col("_score").desc_nulls_last(), *[F.col(t).asc_nulls_first() for t in ties]]
    for parts in (256, 16, 1):
        here = Window.partitionBy(*group, "_part").orderBy(*order)
        rows = rows.withColumn("_part", F.pmod(F.xxhash64(*ties), F.lit(parts))).withColumn("_rank", F.row_number().over(here)).where(F.col("_rank") <= k)
    return rows.withColumn(rank, F.col("_rank")).drop("_score", "_bin", "_part", "_rank")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], *, rows: int = 1 << 20, edges: int = 32) -> DataFrame:
    """(keys, n, q): number of values and their exact quantiles (linear between neighbours) of each group; q is null without values.

    While a group has more than ``rows`` rows left, each round counts its rows between ``edges`` approximate quantiles of its own, and at
    those values: exact counts tell which interval holds each wanted rank, and only rows of those intervals stay. An interval
    holds about 1 / edges of its group, and a value that many rows share is one of its own. So a task holds a sketch per group,
    and in the end the distinct values of one interval. All groups and ranks go through each round together. The values are
    written once, as a round goes over them three times: ``df`` is made once.
    Null keys are groups like any other, NaN counts as null.
    """
    names = [f"k{i}" for i in range(len(keys))]
    data = keep(df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], null_if_nan(F.col(value).cast("double")).alias("v")))
    base = keep(data.groupBy(*names).agg(F.count("v").alias("n")))
    place = lambda p: (F.col("n") - 1) * F.lit(float(p))
    wanted = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(place(p)), F.ceil(place(p))) for p in probs])))
    targets = base.where("n > 0").select(*names, F.lit("").alias("piece"), F.explode(wanted).alias("rank")).withColumn("left", F.col("rank"))
    at, found = [*names, "piece"], None
    active, most = data.where("v IS NOT NULL").withColumn("piece", F.lit("")), base.agg(F.max("n")).first()[0] or 0
    grid = F.array(*[F.lit(i / edges) for i in range(edges + 1)])
    while most > rows:
        cuts = keep(active.groupBy(*at).agg(F.percentile_approx("v", grid, 100 * edges).alias("g")))
        below = F.size(F.filter("g", lambda e: e < F.col("v")))
        spot = (2 * below + F.array_contains("g", F.col("v")).cast("int")).alias("spot")
        placed = active.alias("a").join(cuts.alias("b"), same_rows("a", "b", at)).select("a.*", "b.g").select(*at, "v", spot)
        counted = placed.groupBy(*at, "spot").agg(F.count("*").alias("c"), F.min("v").alias("low"), F.max("v").alias("high"))
        counted = counted.withColumn("under", F.sum("c").over(Window.partitionBy(*at).orderBy("spot")) - F.col("c"))
        met = same_rows("a", "b", at) & (F.col("a.left") >= F.col("b.under")) & (F.col("a.left") < F.col("b.under") + F.col("b.c"))
        told = keep(targets.alias("a").join(counted.alias("b"), met).select("a.*", "b.spot", "b.low", "b.high", "b.under", "b.c"))
        one = told.where("low = high").select(*names, "rank", F.col("low").alias("v"))
        found = one if found is None else found.unionByName(one)
        more = told.where("low < high")
        need = more.select(*at, "spot").distinct()
        piece = F.concat_ws("/", "piece", F.col("spot").cast("string"))
        active = keep(placed.alias("a").join(need.alias("b"), same_rows("a", "b", [*at, "spot"]), "left_semi").withColumn("piece", piece).drop("spot"))
        targets = more.withColumn("piece", piece).withColumn("left", F.col("left") - F.col("under")).select(*at, "rank", "left")
        most = more.agg(F.max("c")).first()[0] or 0
    same = active.groupBy(*at, "v").agg(F.count("*").alias("c"))
    same = same.withColumn("under", F.sum("c").over(Window.partitionBy(*at).orderBy("v")) - F.col("c"))
    asked = targets.groupBy(*at).agg(F.collect_list(F.struct("rank", "left")).alias("t"))
    hit = F.filter("t", lambda x: (x["left"] >= F.col("under")) & (x["left"] < F.col("under") + F.col("c")))
    last = same.alias("a").join(asked.alias("b"), same_rows("a", "b", at)).select("a.*", "b.t").select(*names, "v", F.explode(hit).alias("x")).select(*names, "x.rank", "v")
    found = last if found is None else found.unionByName(last)
    values = found.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("m"))
    both = base.alias("a").join(values.alias("b"), same_rows("a", "b", names), "left").select("a.*", "b.m")

    def between(p: float) -> Column:
        low, high = F.floor(place(p)), F.ceil(place(p))
        a, b = F.try_element_at("m", low), F.try_element_at("m", high)
        return F.when(low == high, a).otherwise((high - place(p)) * a + (place(p) - low) * b)

    return both.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "n", F.when(F.col("m").isNotNull(), F.array(*map(between, probs))).alias("q"))
