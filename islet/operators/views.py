"""The tables behind the usual genome-wide plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from islet.functions.numeric import flag, neg_log10, normal_density, null_if_nan, rounded, same_rows
from islet.operators.intervals import binned_rank, genome_positions
from islet.operators.ranks import exact_quantiles, first_per_group
from islet.operators.xci import kde


#: Marker sizes. Least, most, first and step of outliers a locus; least, most and step of differences; least, most, step and size under the threshold of a sample's points.
LOCUS_SIZE, DELTA_SIZE, POINT_SIZE = (4.0, 18.0, 4, 3), (3.0, 14.0, 14), (6.0, 14.0, 1.5, 4.5)


def outliers_per_locus(flagged: DataFrame, *, group: str = "haplotype") -> DataFrame:
    """Outlying samples and mean z per locus, over rolled-up rows (over all rows where there are none), with the marker size."""
    rows = flagged.where("outlier")
    rolled = rows.agg(F.coalesce(F.max(F.col(group) == "all"), F.lit(False))).scalar()
    rows = rows.where(~rolled | (F.col(group) == "all"))
    # z has four places: whole ten-thousandths add up the same in any order
    whole = F.round(F.col("z_score") * 1e4).cast("long")
    mean = F.try_divide(F.sum(whole).cast("double"), F.count(whole).cast("double"))
    made = rows.groupBy("island_id").agg(F.count_distinct("sample").alias("n_outliers"), (rounded(mean, 0) / 1e4).alias("mean_z"))
    return made.withColumn("size", rounded(F.greatest(F.lit(LOCUS_SIZE[0]), F.least(F.lit(LOCUS_SIZE[1]), LOCUS_SIZE[2] + LOCUS_SIZE[3] * F.log1p("n_outliers"))), 4))


def color_limit(df: DataFrame, column: str, *, q: float = 0.99, floor: float = 1.0, accuracy: int | None = None) -> DataFrame:
    """One row: the ``q`` quantile of |column|, at least ``floor``; exact, or with ``accuracy`` within 1 / accuracy of the rank in one pass."""
    size = F.abs(F.col(column))
    if accuracy is not None:
        made = df.agg(F.percentile_approx(size, q, accuracy).alias("q"))
    else:
        made = exact_quantiles(df.select(F.lit(0).alias("all"), size.alias("x")), ["all"], "x", [q]).agg(F.max(F.get("q", F.lit(0))).alias("q"))
    return made.select(F.greatest(F.coalesce("q", F.lit(floor)), F.lit(floor)).alias("cmax"))


def spread_limit(df: DataFrame, column: str = "z_score", *, times: float = 3.0, floor: float = 2.5) -> DataFrame:
    """One row: three population deviations, at least ``floor``; 3 with at most one value."""
    return df.agg(F.when(F.count(column) > 1, F.greatest(times * F.stddev_pop(column), F.lit(floor))).otherwise(3.0).alias("cmax"))


def deviating(flagged: DataFrame, *, z_thresh: float = 2.5, most: int = 10_000) -> DataFrame:
    """The ``most`` rows of largest |z| that are outliers or pass the threshold."""
    rows = flagged.where(F.col("z_score").isNotNull() & F.col("frac_meth").isNotNull() & F.col("cohort_mean").isNotNull())
    rows = rows.where(F.col("outlier") | flag(F.abs("z_score") >= z_thresh))
    return rows.orderBy(F.abs("z_score").desc(), "sample", "island_id", "haplotype").limit(most)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group; ``order`` must break all ties."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)


def heatmap(flagged: DataFrame, *, most: int = 100, group: str = "haplotype") -> DataFrame:
    """Long form of locus by sample: mean z at the loci with most outlying samples, with the locus's mean z to order rows by."""
    rows = flagged.where(F.col(group) == "all")
    loci = rows.groupBy("island_id").agg(F.count_distinct(F.when(F.col("outlier"), F.col("sample"))).alias("n_outliers")).orderBy(F.desc("n_outliers"), "island_id").limit(most)
    cells = rows.where(F.col("z_score").isNotNull()).join(loci.select("island_id"), "island_id").groupBy("island_id", "sample").agg(F.avg("z_score").alias("z"))
    return cells.withColumn("row_mean", F.avg("z").over(Window.partitionBy("island_id")))


def ordered_loci(stats: DataFrame, chroms: DataFrame | None = None) -> DataFrame:
    """Loci of known mean in order of it: rank and how far the quartiles reach below and above."""
    rows = stats.where(F.col("cohort_mean").isNotNull())
    if chroms is not None:
        rows = rows.join(chroms.select("chrom"), "chrom", "left_semi")
    rows = binned_rank(rows, "cohort_mean", "island_id")
    reach = lambda c: F.greatest(c, F.lit(0.0))
    return rows.withColumn("err_up", reach(F.col("cohort_q75") - F.col("cohort_mean"))).withColumn("err_down", reach(F.col("cohort_mean") - F.col("cohort_q25")))


def haplotypes_side_by_side(counts: DataFrame, keys: Sequence[str] = ("sample", "island_id"), *, first: str = "hap1", second: str = "hap2", group: str = "haplotype", value: str = "frac_meth") -> DataFrame:
    """Mean value of each haplotype per key and their difference, where both have one."""
    mean = lambda h: F.avg(F.when(F.col(group) == h, F.col(value)))
    both = counts.groupBy(*keys).agg(mean(first).alias("hap1"), mean(second).alias("hap2")).where("hap1 IS NOT NULL AND hap2 IS NOT NULL")
    return both.withColumn("delta", F.col("hap1") - F.col("hap2"))


def haplotypic_delta(side_by_side: DataFrame, *, large: float = 0.5) -> DataFrame:
    """Absolute difference per locus: mean, median, deviation, samples, and whether the mean is large."""
    x = rounded(F.abs("delta"), 4)
    whole = F.round(x * 1e4).cast("long")
    n, s, q = F.count(whole), F.sum(whole), F.sum(whole * whole)
    var = F.try_divide(q.cast("double") - s.cast("double") * s.cast("double") / F.nullif(n, F.lit(0)), (n - 1).cast("double")) / 1e8
    made = side_by_side.groupBy("island_id").agg((s.cast("double") / n / 1e4).alias("mean_delta"), F.percentile(x, 0.5).alias("median_delta"), F.sqrt(F.when(n > 1, F.greatest(var, F.lit(0.0)))).alias("std_delta"), F.count_distinct("sample").alias("n_samples"))
    return made.withColumn("large", F.col("mean_delta") >= large)


def volcano(flagged: DataFrame, *, cap: float = 50.0) -> DataFrame:
    """Adds delta to the cohort mean, capped -log10 of the raw p, and the class of each row."""
    rows = flagged.where(F.col("p_value").isNotNull() & F.col("frac_meth").isNotNull() & F.col("cohort_mean").isNotNull())
    delta, sig = F.col("frac_meth") - F.col("cohort_mean"), F.col("p_value") < 0.05
    kind = F.when(sig & (delta > 0.1), "hyper").when(sig & (delta < -0.1), "hypo").when(sig, "sig").otherwise("ns")
    return rows.withColumn("delta", delta).withColumn("neg_logp", neg_log10(F.col("p_value"), cap)).withColumn("category", kind)


def sample_manhattan(flagged: DataFrame, *, haplotype: str = "all", column: str | None = None) -> DataFrame:
    """Adds signed_logp: the sign of z times -log10 of the adjusted p, or of the raw one where the table has no other."""
    p = column or ("p_adj" if "p_adj" in flagged.columns else "p_value")
    rows = flagged.where((F.col("haplotype") == haplotype) & F.col(p).isNotNull() & F.col("z_score").isNotNull())
    return rows.withColumn("signed_logp", F.signum("z_score") * neg_log10(F.col(p)))


def sample_summary(flagged: DataFrame) -> DataFrame:
    """Mean value, loci and outlying loci of each sample."""
    # fractions have four places: whole ten-thousandths add up the same in any order
    whole = F.round(F.col("frac_meth") * 1e4).cast("long")
    mean = F.try_divide(F.sum(whole).cast("double"), F.count(whole).cast("double"))
    return flagged.groupBy("sample").agg((rounded(mean, 2) / 1e4).alias("mean_meth"), F.count_distinct("island_id").alias("n_loci"), F.count_distinct(F.when(F.col("outlier"), F.col("island_id"))).alias("n_outliers"))


def box_summary(df: DataFrame, keys: Sequence[str], value: str, *, accuracy: int | None = None, few_values: bool = False) -> DataFrame:
    """Five numbers of a value per key: exact, by intervals that narrow until a task can hold one; with ``few_values`` (of fractions, say, with four
    places) by counts of each group's distinct ones; with ``accuracy`` within 1 / accuracy of the rank. The last two take one pass."""
    names, probs = ("low", "q25", "median", "q75", "high"), (0.0, 0.25, 0.5, 0.75, 1.0)
    if accuracy is None and not few_values:
        made = exact_quantiles(df, keys, value, probs)
    else:
        q = F.array(*map(F.lit, probs))
        made = df.groupBy(*keys).agg((F.percentile(value, q) if few_values else F.percentile_approx(value, q, accuracy)).alias("q"), F.count(value).alias("n"))
    return made.select(*keys, "n", *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(names)])


def histogram(df: DataFrame, value: str, *, low: float | None = None, high: float | None = None, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, bin, n): even bins from 1, the last with its upper end; values outside aren't counted.

    An end that isn't given is the least or largest value of each group: then a bin's own ``low`` and ``high`` are told too, and every value is in one.
    A group of one value has one bin.
    """
    if low is not None and high is not None:
        inside = df.where(F.col(value).between(low, high))
        at = F.least(F.floor((F.col(value) - low) / ((high - low) / bins)) + 1, F.lit(bins))
        return inside.groupBy(*keys, at.cast("long").alias("bin")).agg(F.count("*").alias("n"))
    x = null_if_nan(F.col(value).cast("double"))
    told = df.select(*keys, x.alias("_x")).where("_x IS NOT NULL")
    ends = told.groupBy(*keys).agg((F.min("_x") if low is None else F.lit(float(low))).alias("_low"), (F.max("_x") if high is None else F.lit(float(high))).alias("_high"))
    # one row a group: Spark broadcasts it where it is small
    both = told.alias("a").join(ends.alias("b"), same_rows("a", "b", keys)).select("a.*", "b._low", "b._high").where("_x BETWEEN _low AND _high")
    width = (F.col("_high") - F.col("_low")) / bins
    at = F.when(width > 0, F.least(F.floor((F.col("_x") - F.col("_low")) / width) + 1, F.lit(bins))).otherwise(1).cast("long")
    made = both.groupBy(*keys, at.alias("bin")).agg(F.count("*").alias("n"), F.first("_low").alias("_low"), F.first("_high").alias("_high"))
    return made.select(*keys, "bin", "n", (F.col("_low") + (F.col("bin") - 1) * width).alias("low"), F.when(width > 0, F.col("_low") + F.col("bin") * width).otherwise(F.col("_high")).alias("high"))


def embedding_table(coords: DataFrame, summary: DataFrame) -> DataFrame:
    """Coordinates with each sample's summary; samples without one have no outliers."""
    return coords.join(summary, "sample", "left").withColumn("n_outliers", F.coalesce("n_outliers", F.lit(0)))


POSITION = ("island_name", "chrom", "island_start", "island_end")


def first_per_locus(df: DataFrame, columns: Sequence[str] = POSITION, *, locus: str = "island_id") -> DataFrame:
    """One row a locus with the least set of the columns that it has, by an aggregate that needs no sort."""
    return df.groupBy(locus).agg(F.min(F.struct(*columns)).alias("one")).select(locus, *[F.col(f"one.{c}").alias(c) for c in columns])


def on_genome(df: DataFrame, chroms: DataFrame) -> DataFrame:
    """Adds ord and x_pos by the island's middle; rows of chromosomes that aren't listed go."""
    return genome_positions(df, chroms, start="island_start", end="island_end")


def loci_in_order(df: DataFrame, chroms: DataFrame) -> DataFrame:
    """Each locus once, with ord: sort by ord, island_id."""
    return first_per_locus(df).join(chroms.select("chrom", "ord"), "chrom")


def manhattan(flagged: DataFrame, chroms: DataFrame) -> DataFrame:
    """``outliers_per_locus`` on the genome axis."""
    return on_genome(outliers_per_locus(flagged).join(first_per_locus(flagged), "island_id"), chroms)


def manhattan_by_haplotype(flagged: DataFrame, chroms: DataFrame, *, most: int = 10_000, z_order: Sequence[str] = ("sample", "island_id")) -> DataFrame:
    """The ``most`` outliers of largest |z| of each haplotype on the genome axis, with the parity of their chromosome."""
    rows = first_per_group(flagged.where("outlier"), ["haplotype"], F.abs("z_score"), z_order, most)
    return on_genome(rows, chroms).withColumn("odd_chrom", F.col("ord") % 2 == 1)


def haplotypic_delta_manhattan(side_by_side: DataFrame, loci: DataFrame, chroms: DataFrame) -> DataFrame:
    """``haplotypic_delta`` on the genome axis, with the marker size."""
    rows = on_genome(haplotypic_delta(side_by_side).join(first_per_locus(loci), "island_id"), chroms)
    return rows.withColumn("size", rounded(F.greatest(F.lit(DELTA_SIZE[0]), F.least(F.lit(DELTA_SIZE[1]), DELTA_SIZE[0] + DELTA_SIZE[2] * F.col("mean_delta"))), 4))


def sample_manhattan_points(flagged: DataFrame, chroms: DataFrame, *, z_thresh: float = 2.5, top_labels: int = 3, haplotype: str = "all") -> DataFrame:
    """``sample_manhattan`` on the genome axis: marker size, and a label for the largest |z| of each sample and chromosome over the threshold.

    A label is the locus's name, or id without one, of at most 18 characters.
    """
    rows = on_genome(sample_manhattan(flagged, haplotype=haplotype), chroms)
    beyond = F.abs("z_score") - z_thresh
    size = F.when(beyond >= 0, F.greatest(F.lit(POINT_SIZE[0]), F.least(F.lit(POINT_SIZE[1]), POINT_SIZE[0] + POINT_SIZE[2] * beyond))).otherwise(POINT_SIZE[3])
    rank = F.row_number().over(Window.partitionBy("sample", "chrom").orderBy(F.abs("z_score").desc(), "island_id"))
    name = F.coalesce(F.nullif(F.trim("island_name"), F.lit("")), F.col("island_id"))
    short = F.when(F.length(name) > 18, F.concat(F.substring(name, 1, 17), F.lit("…"))).otherwise(name)
    return rows.withColumn("size", rounded(size, 4)).withColumn("label", F.when((beyond >= 0) & (rank <= top_labels), short))


def smallest_p(flagged: DataFrame, *, k: int = 10) -> DataFrame:
    """The k smallest raw p of each haplotype."""
    rows = flagged.where("p_value IS NOT NULL")
    return top_per_group(rows, ["haplotype"], [F.col("p_value"), F.abs("z_score").desc(), F.col("sample"), F.col("island_id")], k)


#: Panels of the locus distributions and their bins. Fixed values.
PANELS = {"island_size": 50, "island_cpgNum": 40, "cohort_mean": 50}


def locus_distributions(stats: DataFrame, *, bins: dict[str, int | tuple[float, float, int]] = PANELS) -> DataFrame:
    """(panel, bin, n, low, high): histograms of island size, sites and cohort mean over rolled-up loci.

    ``bins``: panel -> number of bins over the panel's own range, so that every locus is counted, or (low, high, number).
    All panels of their own range are one table that is binned together.
    """
    rows = stats.where("haplotype = 'all'").withColumn("island_size", F.col("island_end") - F.col("island_start"))
    made = None
    for n in sorted({b for b in bins.values() if isinstance(b, int)}):
        each = F.explode(F.array(*[F.struct(F.lit(p).alias("panel"), F.col(p).cast("double").alias("x")) for p, b in bins.items() if b == n]))
        one = histogram(rows.select(each.alias("one")).select("one.*"), "x", bins=n, keys=["panel"])
        made = one if made is None else made.unionByName(one)
    for panel, given in bins.items():
        if not isinstance(given, int):
            low, high, n = given
            edge = lambda i: F.lit(low) + i * ((high - low) / n)
            one = histogram(rows, panel, low=low, high=high, bins=n).select(F.lit(panel).alias("panel"), "bin", "n", edge(F.col("bin") - 1).alias("low"), edge(F.col("bin")).alias("high"))
            made = one if made is None else made.unionByName(one)
    return made


def qc_records(coords: DataFrame, qc: DataFrame, *, x: str = "pc1", y: str = "pc2") -> DataFrame:
    """One record a sample of the embedding: its place, its metrics (zero where it has none), reasons and whether it is suggested for exclusion."""
    numbers = ("mean_meth", "coverage_frac", "mean_reads", "mahal_dist")
    told = coords.select("sample", F.col(x).alias("x"), F.col(y).alias("y")).join(qc, "sample", "left")
    return told.select("sample", "x", "y", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in numbers], F.coalesce("qc_reasons", F.lit("")).alias("qc_reasons"), flag(F.col("qc_outlier")).alias("auto_exclude"))


def qc_bars(qc: DataFrame, panels: Sequence[str] = ("coverage_frac", "mean_meth", "mean_reads")) -> DataFrame:
    """(panel, sample, value, outlier): one bar a sample and metric."""
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("panel"), F.col(p).cast("double").alias("value")) for p in panels]))
    return qc.select("sample", flag(F.col("qc_outlier")).alias("outlier"), each.alias("one")).select("one.panel", "sample", "one.value", "outlier")


def haplotype_percentages(hemi: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, series, pct): percentages of each haplotype, and of both together."""
    sides = [F.struct(F.lit(s).alias("series"), (F.col(f"meth_frac_{h}") * 100).alias("pct")) for h in ("hap1", "hap2") for s in (h, "combined")]
    return hemi.select(*keys, F.explode(F.array(*sides)).alias("one")).select(*keys, "one.*").where("pct IS NOT NULL")


def xci_scatter(hemi: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, island_id, hap1_pct, hap2_pct, abs_delta) of the kept islands."""
    return hemi.select(*keys, "island_id", (F.col("meth_frac_hap1") * 100).alias("hap1_pct"), (F.col("meth_frac_hap2") * 100).alias("hap2_pct"), F.abs(F.col("meth_frac_hap1") - F.col("meth_frac_hap2")).alias("abs_delta"))


def xci_distribution(hemi: DataFrame, *, points: int = 500, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, series, i, x, density): kernel densities of the three series of percentages, together."""
    return kde(haplotype_percentages(hemi, keys=keys), points=points, keys=[*keys, "series"])


def xci_histogram(hemi: DataFrame, *, bins: int = 50, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, series, bin, n): counts of the three series of percentages in even bins of 0 to 100."""
    return histogram(haplotype_percentages(hemi, keys=keys), "pct", low=0.0, high=100.0, bins=bins, keys=[*keys, "series"])


def normal_overlay(grid: DataFrame, fit: dict, *, x: str = "x", n: float = 1.0, width: float = 1.0) -> DataFrame:
    """(x, component, density): the two weighted normal curves of a mixture fit over a grid, scaled to ``n`` values in bins of ``width``."""
    curves = [F.struct(F.lit(s).alias("component"), (n * width * fit[f"weight_{s}"] * normal_density(F.col(x), F.lit(fit[f"mean_{s}"]), F.lit(fit[f"sd_{s}"]))).alias("density")) for s in ("low", "high")]
    return grid.select(x, F.explode(F.array(*curves)).alias("one")).select(x, "one.*")


def mixture_overlays(fits: DataFrame, *, keys: Sequence[str] = (), low: float = 0.0, high: float = 100.0, points: int = 500, bins: int = 50) -> DataFrame:
    """(keys, plot, component, i, x, y): the two normal curves of each group's mixture over an even grid, as drawn on its distribution
    (densities) and on its histogram (values a bin: times the number of values and a bin's width)."""
    grid = [low + (high - low) * i / (points - 1) for i in range(points)]
    at = fits.select("*", F.posexplode(F.array(*map(F.lit, grid))).alias("i", "x"))
    curve = lambda side: F.col(f"weight_{side}") * normal_density(F.col("x"), F.col(f"mean_{side}"), F.col(f"sd_{side}"))
    each = [F.struct(F.lit(plot).alias("plot"), F.lit(side).alias("component"), (times * curve(side)).alias("y")) for plot, times in (("distribution", F.lit(1.0)), ("histogram", F.col("n") * ((high - low) / bins))) for side in ("low", "high")]
    return at.select(*keys, "i", "x", F.explode(F.array(*each)).alias("one")).select(*keys, "one.plot", "one.component", "i", "x", "one.y")


def wide(df: DataFrame, row: str, column: str, value: str, columns: Sequence[str]) -> DataFrame:
    """For export: one row a ``row``, the mean value under each of the given ``columns``; columns without any value are left out by not being given."""
    return df.groupBy(row).pivot(column, list(columns)).agg(F.avg(value))


def headline(stats: DataFrame) -> DataFrame:
    """One row: loci, and the median of their samples, truncated."""
    return stats.agg(F.count_distinct("island_id").alias("n_loci"), F.median("cohort_n_samples").cast("long").alias("median_samples"))


def genome_sorted(df: DataFrame) -> DataFrame:
    """Rows with ``ord`` in the order of the genome."""
    return df.orderBy("ord", "island_start", "island_id")
