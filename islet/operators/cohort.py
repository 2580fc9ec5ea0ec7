"""Cohort statistics per locus, z-scores, p-values, false-discovery rates and outlier flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from islet.functions.numeric import flag, null_if_nan, ratio, rounded, same_rows, two_sided_p
from islet.functions.storage import keep

LOCUS = ("island_id", "haplotype")


def _moments(value: Column) -> tuple[Column, Column, Column]:
    """Count, mean and variance aggregates of a fraction with four places, by its whole ten-thousandths: sums don't depend on their order."""
    whole = F.round(value * 1e4).cast("long")
    n, s, q = F.count(whole), F.sum(whole), F.sum(whole * whole)
    mean = F.try_divide(s.cast("double"), n.cast("double")) / 1e4
    var = F.try_divide(q.cast("double") - s.cast("double") * s.cast("double") / F.nullif(n, F.lit(0)), (n - 1).cast("double")) / 1e8
    return n, mean, F.when(n > 1, F.greatest(var, F.lit(0.0)))


def locus_stats(counts: DataFrame, *, keys: Sequence[str] = LOCUS, sample: str = "sample", value: str = "frac_meth", min_samples: int = 5, attributes: Sequence[str] = ()) -> DataFrame:
    """Samples, mean, standard deviation, exact quartiles, extremes and IQR per locus and group.

    With fewer than ``min_samples`` samples all but the extremes are null. Null keys are groups like any other. ``attributes``
    describe the keys and come along; a key with two different sets of them fails the job, as its rows would be torn apart.
    """
    x = null_if_nan(F.col(value))
    n, mean, var = _moments(x)
    described = F.struct(*attributes) if attributes else F.lit(None)
    made = counts.groupBy(*keys).agg(
        F.min(described).alias("_least"), F.max(described).alias("_most"),
        F.count_distinct(sample).alias("cohort_n_samples"), mean.alias("mean"), F.sqrt(var).alias("std"), F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.min(x).alias("cohort_min"), F.max(x).alias("cohort_max")
    )
    one = F.when(F.col("_least").eqNullSafe(F.col("_most")), F.col("_least")).otherwise(F.raise_error(F.concat(F.lit("several attributes of one locus: "), F.to_json("_least"), F.lit(" "), F.to_json("_most")))) if attributes else None
    made = made.withColumn("_one", one) if attributes else made
    enough = lambda c: F.when(F.col("cohort_n_samples") >= min_samples, c)
    q = [F.get("q", F.lit(i)) for i in range(3)]
    return made.select(
        *keys, *[F.col(f"_one.{a}").alias(a) for a in attributes], "cohort_n_samples", enough(F.col("mean")).alias("cohort_mean"), enough(F.col("std")).alias("cohort_std"), enough(q[1]).alias("cohort_median"),
        enough(q[0]).alias("cohort_q25"), enough(q[2]).alias("cohort_q75"), "cohort_min", "cohort_max", enough(q[2] - q[0]).alias("cohort_IQR"),
    )


def _described(counts: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row with its group's values: by a join, so that a group of a third of all rows can still be split."""
    more = [f"b.`{c}`" for c in groups.columns if c not in keys]
    return counts.alias("a").join(groups.alias("b"), same_rows("a", "b", keys), "left").select("a.*", *more)


def score_standard(counts: DataFrame, stats: DataFrame, *, keys: Sequence[str] = LOCUS, value: str = "frac_meth") -> DataFrame:
    """z against the whole cohort, to four places; null where the deviation is zero or unknown."""
    kept = stats.select(*keys, *[c for c in stats.columns if c.startswith("cohort_") and c not in ("cohort_min", "cohort_max")])
    z = ratio(F.col(value) - F.col("cohort_mean"), F.nullif(F.col("cohort_std"), F.lit(0.0)))
    return _described(counts, kept, keys).withColumn("z_score", rounded(z, 4))


def score_leave_one_out(counts: DataFrame, *, keys: Sequence[str] = LOCUS, sample: str = "sample", value: str = "frac_meth", min_samples: int = 5, compat: bool = False) -> DataFrame:
    """z of each sample against the others, by the closed form from the group's moments.

    ``compat`` takes the variance that subtracts the whole squared distance to the others' mean, clamps it at zero, and
    leaves the quartiles unmasked, for users who need those numbers.
    """
    x = null_if_nan(F.col(value))
    n, mean, var = _moments(x)
    group = counts.groupBy(*keys).agg(F.count_distinct(sample).alias("cohort_n_samples"), n.alias("n"), mean.alias("mu"), var.alias("s2"), F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    enough = F.col("cohort_n_samples") >= min_samples
    joined = _described(counts, group, keys)
    n, mu, s2 = F.col("n"), F.col("mu"), F.col("s2")
    others = F.when(enough & (n > 1), ratio(n * mu - x, n - 1))
    off = (x - others) * (x - others) if compat else (x - mu) * (x - others)
    left = F.when(enough & (n > 2), F.greatest(F.lit(0.0), ratio((n - 1) * s2 - off, n - 2)))
    masked = lambda c: c if compat else F.when(enough, c)
    q = [masked(F.get("q", F.lit(i))) for i in range(3)]
    scored = joined.withColumn("cohort_mean", rounded(others, 6)).withColumn("cohort_std", F.sqrt(left))
    for name, c in (("cohort_median", q[1]), ("cohort_q25", q[0]), ("cohort_q75", q[2]), ("cohort_IQR", q[2] - q[0])):
        scored = scored.withColumn(name, c)
    # a deviation lost in rounding is none
    sd = F.when(F.col("cohort_std") > 1e-9, F.col("cohort_std"))
    return scored.withColumn("z_score", rounded(ratio(x - F.col("cohort_mean"), sd), 4)).drop("n", "mu", "s2", "q")


def bh_fdr(df: DataFrame, *, p: str = "p_value", group: str = "haplotype", out: str = "p_adj", bins: int = 4096) -> DataFrame:
    """Benjamini-Hochberg adjusted p-values within each group; null p stays null and doesn't count.

    Equal p of a group are one row with a count, so ties weigh nothing. Few large groups would leave few tasks, so each is
    cut into ``bins`` by p: ranks are the rank in the bin plus what lies in lower bins, and the running minimum is the one in the
    bin and the least of the bins above. Windows over bins see one row a bin; the others see one bin. The distinct p and their
    adjusted values are written once, so ``df`` is gone over twice, however many steps there are.
    """
    told = df.where(F.col(p).isNotNull()).groupBy(F.col(group).alias("g"), F.col(p).alias("p")).agg(F.count("*").alias("n"))
    told = keep(told.withColumn("bin", F.floor(F.col("p") * bins)))
    along = Window.partitionBy("g").orderBy("bin")
    sizes = told.groupBy("g", "bin").agg(F.sum("n").alias("in_bin"))
    sizes = sizes.withColumn("below", F.sum("in_bin").over(along) - F.col("in_bin")).withColumn("m", F.sum("in_bin").over(Window.partitionBy("g")))
    rows = told.alias("a").join(sizes.alias("b"), same_rows("a", "b", ["g", "bin"])).select("a.*", "b.below", "b.m")
    here = Window.partitionBy("g", "bin")
    rank = F.col("below") + F.sum("n").over(here.orderBy("p"))
    rows = rows.withColumn("adj", F.col("p") * F.col("m") / rank)
    rows = keep(rows.withColumn("own", F.min("adj").over(here.orderBy(F.desc("p")))))
    least = rows.groupBy("g", "bin").agg(F.min("adj").alias("low"))
    least = least.withColumn("above", F.min("low").over(Window.partitionBy("g").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)))
    rows = keep(rows.alias("a").join(least.alias("b"), same_rows("a", "b", ["g", "bin"])).select("a.g", "a.p", F.least(F.lit(1.0), "a.own", "b.above").alias("_adjusted")))
    # an equality on p and a null-safe one on the group: rows of null p meet nothing
    met = F.col(f"a.`{p}`").eqNullSafe(F.col("b.p")) & F.col(f"a.`{group}`").eqNullSafe(F.col("b.g"))
    return df.alias("a").join(rows.alias("b"), met, "left").select("a.*", F.col("b._adjusted").alias(out))


def bh_row_order(df: DataFrame, *, p: str = "p_value", group: str = "haplotype", order: Sequence[str], out: str = "p_adj") -> DataFrame:
    """As some tables have it: each p times m over its rank, with the running minimum from the last row up in row order, not by p."""
    here = Window.partitionBy(group)
    rank = F.row_number().over(here.orderBy(F.col(p).asc_nulls_last(), *order))
    raw = F.when(F.col(p).isNotNull(), F.col(p) * F.count(p).over(here) / rank)
    told = df.withColumn("_raw", raw)
    back = Window.partitionBy(group).orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return told.withColumn(out, F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.min("_raw").over(back)))).drop("_raw")


def tukey_outlier(value: Column, q25: Column, q75: Column, iqr: Column, k: float = 1.5) -> Column:
    """Strictly outside the fences; an unknown IQR counts as zero, unknown quartiles as no fence."""
    reach = k * F.coalesce(iqr, F.lit(0.0))
    return flag((value < q25 - reach) | (value > q75 + reach))


def add_pvalues_and_flags(scored: DataFrame, *, z_thresh: float = 2.5, value: str = "frac_meth", group: str = "haplotype") -> DataFrame:
    """p from the rounded z, its adjusted value within each group, and the flags: IQR, z, either."""
    made = bh_fdr(scored.withColumn("p_value", two_sided_p(F.col("z_score"))), group=group)
    made = made.withColumn("IQR_outlier", tukey_outlier(F.col(value), F.col("cohort_q25"), F.col("cohort_q75"), F.col("cohort_IQR")))
    made = made.withColumn("Z_outlier", flag(F.abs("z_score") >= z_thresh))
    return made.withColumn("outlier", F.col("IQR_outlier") | F.col("Z_outlier"))


def sorted_outliers(flagged: DataFrame) -> DataFrame:
    """Outlier rows by locus, group, and falling |z|, unknown z last."""
    return flagged.where("outlier").orderBy("island_id", "haplotype", F.abs("z_score").desc_nulls_last())
