"""Reads across islands: classes, per-island tables, inactivation bias, track rows and summaries."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from islet.functions.numeric import normal_density, ratio, rounded, same_rows
from islet.functions.storage import keep

ISLAND = ("island_id", "island_chrom", "island_start", "island_end")
HAPLOTYPES = {"hap1": 1, "hap2": 2, "unphased": 0}


def usable_reads(reads: DataFrame, *, drop_duplicates: bool) -> DataFrame:
    """Primary mapped reads; optionally without marked duplicates."""
    ok = ~F.col("is_unmapped") & ~F.col("is_secondary") & ~F.col("is_supplementary")
    return reads.where(ok & ~F.col("is_duplicate") if drop_duplicates else ok)


def classify_read(n_meth: Column, n_cpg: Column, threshold: float = 0.75) -> Column:
    """methylated or unmethylated when at least ``threshold`` of the sites agree, else partial; null without sites."""
    part = ratio(n_meth, n_cpg)
    return F.when(part >= threshold, "methylated").when(part <= 1 - threshold, "unmethylated").when(part.isNotNull(), "partial")


def per_island(per_read: DataFrame, keys: Sequence[str] = ISLAND, *, start: str | None = "island_start", end: str | None = "island_end") -> DataFrame:
    """Per island and haplotype reads by class and the methylated part of the clear ones; difference of the haplotypes and totals."""
    made = []
    for name, hp in HAPLOTYPES.items():
        here = F.col("haplotype") == hp
        n = {c: F.count(F.when(here & (F.col("classification") == c), 1)) for c in ("methylated", "unmethylated", "partial")}
        made += [F.count(F.when(here, 1)).alias(f"n_reads_{name}"), n["methylated"].alias(f"n_meth_{name}"), n["unmethylated"].alias(f"n_unmeth_{name}"), n["partial"].alias(f"n_partial_{name}")]
    out = per_read.groupBy(*keys).agg(*made)
    clear = lambda h: F.col(f"n_meth_{h}") + F.col(f"n_unmeth_{h}")
    for h in HAPLOTYPES:
        out = out.withColumn(f"meth_frac_{h}", rounded(ratio(F.col(f"n_meth_{h}"), clear(h)), 4))
    if start:
        out = out.withColumn("island_length", F.col(end) - F.col(start))
    out = out.withColumn("delta_meth", rounded(F.col("meth_frac_hap1") - F.col("meth_frac_hap2"), 4))
    out = out.withColumn("n_informative_total", clear("hap1") + clear("hap2")).withColumn("n_meth_total", F.col("n_meth_hap1") + F.col("n_meth_hap2"))
    return out.withColumn("meth_frac_combined", rounded(ratio(F.col("n_meth_total"), F.col("n_informative_total")), 4))


def hemi_methylated(islands: DataFrame, *, min_reads: int = 8, low: float = 0.40, high: float = 0.60) -> DataFrame:
    """Islands with enough clear reads on both haplotypes whose combined part is within [low, high]."""
    clear = lambda h: F.col(f"n_meth_{h}") + F.col(f"n_unmeth_{h}") >= min_reads
    return islands.where(clear("hap1") & clear("hap2") & F.col("meth_frac_combined").between(low, high))


#: Colours and names of the track. Fixed values.
GREY, BLUE, RED, FULL_DELTA = (210, 210, 210), (10, 80, 200), (200, 50, 10), 0.5
STATUS_RGB = {"no_data": "200,200,200", "low_cov": "170,170,170", "unmethylated": "140,190,230", "methylated": "230,160,100"}
PAR_RGB = "128,128,128"


def delta_rgb(delta: Column) -> Column:
    """``r,g,b`` from GREY at 0 to BLUE (hap1 more) or RED (hap2 more) at a difference of FULL_DELTA and more; parts truncated."""
    t = F.least(F.abs(delta) / FULL_DELTA, F.lit(1.0))
    part = lambda i: F.when(delta >= 0, GREY[i] + t * (BLUE[i] - GREY[i])).otherwise(GREY[i] + t * (RED[i] - GREY[i]))
    return F.concat_ws(",", *[(part(i) + 1e-9).cast("int").cast("string") for i in range(3)])


def percent(part: Column) -> Column:
    """``27%``: whole percents, ties to even."""
    return F.concat(F.bround(part * 100, 0).cast("int").cast("string"), F.lit("%"))


def island_status(islands: DataFrame, *, min_reads: int = 8, low: float = 0.40, high: float = 0.60) -> DataFrame:
    """Adds status, label (the status with its numbers), score and rgb of each island's row in a browser track; islands without clear reads have no data."""
    clear = lambda h: F.coalesce(F.col(f"n_meth_{h}") + F.col(f"n_unmeth_{h}"), F.lit(0)).cast("long")
    part, delta = F.col("meth_frac_combined"), F.col("delta_meth")
    few = (clear("hap1") < min_reads) | (clear("hap2") < min_reads)
    status = F.when(part.isNull(), "no_data").when(few, "low_cov").when(part < low, "unmethylated").when(part > high, "methylated").otherwise("delta")
    told = islands.withColumn("status", status)
    is_a = lambda s: F.col("status") == s
    signed = F.concat(F.when(delta < 0, "-").otherwise("+"), F.format_string("%.2f", rounded(F.abs(delta), 2)))
    said = {
        "low_cov": F.concat(F.lit("low_cov(h1="), clear("hap1").cast("string"), F.lit(",h2="), clear("hap2").cast("string"), F.lit(")")),
        "unmethylated": F.concat(F.lit("unmethylated(comb="), percent(part), F.lit(")")),
        "methylated": F.concat(F.lit("methylated(comb="), percent(part), F.lit(")")),
        "delta": F.concat(F.lit("d="), signed, F.lit("(h1="), percent(F.col("meth_frac_hap1")), F.lit(",h2="), percent(F.col("meth_frac_hap2")), F.lit(")")),
    }
    label, rgb = F.lit("no_data"), delta_rgb(delta)
    for name, text in said.items():
        label = F.when(is_a(name), text).otherwise(label)
    for name, colour in STATUS_RGB.items():
        rgb = F.when(is_a(name), colour).otherwise(rgb)
    score = F.when(is_a("delta"), F.least((F.abs(delta) * 1000 + 1e-9).cast("int"), F.lit(1000))).otherwise(0)
    return told.withColumn("label", label).withColumn("score", score).withColumn("rgb", rgb)


def bed9(islands: DataFrame, par: DataFrame | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, start, is_par, line) of a nine-column track, pseudoautosomal islands marked; sort by start, is_par descending to write."""
    line = lambda chrom, start, end, name, score, rgb: F.concat_ws("\t", chrom, start.cast("string"), end.cast("string"), name, score.cast("string"), F.lit("."), start.cast("string"), end.cast("string"), rgb)
    col = F.col
    rows = islands.select(*keys, col("island_start").alias("start"), F.lit(False).alias("is_par"), line(col("island_chrom"), col("island_start"), col("island_end"), F.concat_ws("|", "island_id", "label"), col("score"), col("rgb")).alias("line"))
    if par is None:
        return rows
    inside = par.select(*keys, col("start"), F.lit(True).alias("is_par"), line(col("chrom"), col("start"), col("end"), F.concat_ws("|", "name", F.lit("PAR")), F.lit(0), F.lit(PAR_RGB)).alias("line"))
    return rows.unionByName(inside)


def sex_of(contigs: DataFrame, *, keys: Sequence[str] = ("sample",), contig: str = "contig", mapped: str = "mapped", threshold: float = 0.10) -> DataFrame:
    """Adds y_ratio, chrY of chrX and chrY reads, and sex: M above the threshold, F otherwise, unknown without reads."""
    reads = lambda c: F.coalesce(F.sum(F.when(F.col(contig) == c, F.col(mapped))), F.lit(0))
    made = contigs.groupBy(*keys).agg(reads("chrX").cast("long").alias("x_reads"), reads("chrY").cast("long").alias("y_reads"))
    made = made.withColumn("y_ratio", ratio(F.col("y_reads"), F.col("x_reads") + F.col("y_reads")))
    return made.withColumn("sex", F.when(F.col("y_ratio").isNull(), "unknown").when(F.col("y_ratio") > threshold, "M").otherwise("F"))


def gaussian_mixture(values: DataFrame, *, value: str = "pct", means: tuple[float, float] = (25.0, 75.0), rounds: int = 300, tolerance: float = 1e-3, floor: float = 1e-6, least: int = 10) -> dict | None:
    """Two normal components of a column, by expectation maximisation from the given means; null under ``least`` values.

    A round is one aggregate over the table that returns six sums, so the values stay where they are.
    """
    first = values.agg(F.count(value).alias("n"), F.var_pop(value).alias("v")).first()
    if first.n < least:
        return None
    w, mu, var, before = [0.5, 0.5], list(map(float, means)), [max(first.v, floor)] * 2, None
    values = values.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("x")).persist()
    x = F.col("x")
    for _ in range(rounds):
        d = [w[k] * normal_density(x, F.lit(mu[k]), F.lit(var[k] ** 0.5)) for k in (0, 1)]
        told = values.select("x", (d[0] + d[1]).alias("d"), d[0].alias("d0")).select("x", F.coalesce(F.try_divide(F.col("d0"), F.col("d")), (F.abs(x - mu[0]) < F.abs(x - mu[1])).cast("double")).alias("r"), F.log(F.greatest("d", F.lit(1e-300))).alias("l"))
        r = told.agg(F.sum("r"), F.sum(F.col("r") * x), F.sum(F.col("r") * x * x), F.sum(1 - F.col("r")), F.sum((1 - F.col("r")) * x), F.sum((1 - F.col("r")) * x * x), F.avg("l")).first()
        for k in (0, 1):
            n = max(r[3 * k], 1e-10)
            w[k], mu[k] = r[3 * k] / first.n, r[3 * k + 1] / n
            var[k] = max(r[3 * k + 2] / n - mu[k] ** 2, 0.0) + floor
        if before is not None and abs(r[6] - before) < tolerance:
            break
        before = r[6]
    values.unpersist()
    low, high = sorted(range(2), key=lambda k: mu[k])
    return {f"{name}_{side}": x[k] for side, k in (("low", low), ("high", high)) for name, x in (("weight", w), ("mean", mu), ("sd", [v**0.5 for v in var]))}


def gaussian_mixtures(values: DataFrame, keys: Sequence[str], *, value: str = "pct", means: tuple[float, float] = (25.0, 75.0), rounds: int = 300, tolerance: float = 1e-3, floor: float = 1e-6, least: int = 10) -> DataFrame:
    """``gaussian_mixture`` of every group at once: (keys, n, weight_low, mean_low, sd_low, weight_high, mean_high, sd_high, rounds).

    The fits are a table of one row a group. A round joins it to the values (equal ones of a group are one row with a count) and takes
    one grouped pass; groups whose mean log-likelihood stands still leave, so later rounds see the others alone. Groups under
    ``least`` values have no row. Null keys are a group.
    """
    names = [f"k{i}" for i in range(len(keys))]
    told = values.where(F.col(value).isNotNull()).groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(value).cast("double").alias("x")).agg(F.count("*").alias("c"))
    told = keep(told)
    w = F.col("c").cast("double")
    n, s, q = F.sum("c"), F.sum(w * F.col("x")), F.sum(w * F.col("x") * F.col("x"))
    start = told.groupBy(*names).agg(n.alias("n"), F.greatest(q / n - (s / n) * (s / n), F.lit(floor)).alias("v")).where(F.col("n") >= least)
    fits = keep(start.select(*names, "n", F.lit(0.5).alias("w0"), F.lit(0.5).alias("w1"), F.lit(float(means[0])).alias("m0"), F.lit(float(means[1])).alias("m1"), F.col("v").alias("v0"), F.col("v").alias("v1"), F.lit(None).cast("double").alias("l"), F.lit(False).alias("done"), F.lit(0).alias("rounds")))
    made, columns = None, fits.columns
    for i in range(rounds):
        x = F.col("x")
        d = [F.col(f"w{k}") * normal_density(x, F.col(f"m{k}"), F.sqrt(f"v{k}")) for k in (0, 1)]
        both = told.alias("a").join(fits.alias("b"), same_rows("a", "b", names)).select("b.*", "x", "c").withColumn("d0", d[0]).withColumn("d", F.col("d0") + d[1])
        both = both.withColumn("r", F.coalesce(F.try_divide("d0", "d"), (F.abs(x - F.col("m0")) < F.abs(x - F.col("m1"))).cast("double")) * w)
        sums = {"n0": F.col("r"), "a0": F.col("r") * x, "b0": F.col("r") * x * x, "n1": w - F.col("r"), "a1": (w - F.col("r")) * x, "b1": (w - F.col("r")) * x * x}
        got = both.groupBy(*names).agg(F.first("n").alias("n"), F.first("l").alias("was"), *[F.sum(e).alias(c) for c, e in sums.items()], (F.sum(w * F.log(F.greatest("d", F.lit(1e-300)))) / F.first("n")).alias("l"))
        part = lambda k: F.greatest(f"n{k}", F.lit(1e-10))
        fresh = [(F.col(f"n{k}") / F.col("n")).alias(f"w{k}") for k in (0, 1)] + [(F.col(f"a{k}") / part(k)).alias(f"m{k}") for k in (0, 1)]
        fresh += [(F.greatest(F.col(f"b{k}") / part(k) - (F.col(f"a{k}") / part(k)) * (F.col(f"a{k}") / part(k)), F.lit(0.0)) + floor).alias(f"v{k}") for k in (0, 1)]
        still = F.coalesce(F.abs(F.col("l") - F.col("was")) < tolerance, F.lit(False)) | F.lit(i == rounds - 1)
        now = keep(got.select(*names, "n", *fresh, "l", still.alias("done"), F.lit(i + 1).alias("rounds")).select(columns))
        over = now.where("done")
        made = over if made is None else made.unionByName(over)
        fits = now.where("NOT done")
        if fits.isEmpty():
            break
    first = F.col("m0") <= F.col("m1")
    sides = [(side, F.when(first, F.struct(*[F.col(f"{c}{a}").alias(c) for c in "wmv"])).otherwise(F.struct(*[F.col(f"{c}{b}").alias(c) for c in "wmv"]))) for side, a, b in (("low", 0, 1), ("high", 1, 0))]
    out = [F.col(k).alias(name) for k, name in zip(names, keys)]
    return made.select(*out, "n", *[e for side, s in sides for e in (s["w"].alias(f"weight_{side}"), s["m"].alias(f"mean_{side}"), F.sqrt(s["v"]).alias(f"sd_{side}"))], "rounds")


def bias_read_backed(fit: dict) -> float:
    """Inactivation bias from two components of per-haplotype percentages."""
    return (fit["mean_low"] / 100 + 1 - fit["mean_high"] / 100) / 2


def bias_pedigree(islands: DataFrame) -> DataFrame:
    """One row: each haplotype's median part as its bias."""
    return islands.agg(*[F.percentile(f"meth_frac_{h}", 0.5).alias(f"xci_bias_{h}") for h in ("hap1", "hap2")])


def kde(values: DataFrame, *, value: str = "pct", low: float = 0.0, high: float = 100.0, points: int = 500, keys: Sequence[str] = (), order: int = 12) -> DataFrame:
    """(keys, i, x, density): Gaussian kernels with Scott's bandwidth on an even grid; no rows of a group under two values or without spread.

    Values never meet the grid: they are gathered in cells a quarter of a bandwidth wide, of each of which the first ``order`` moments about
    its middle are kept, by one pre-aggregated pass. A kernel is a series in its value's distance to the middle, whose terms are
    Hermite polynomials of the grid point's distance; with twelve terms it is exact to the last places. So the cells in reach of the
    grid, at most its length over a quarter bandwidth, meet it instead: cells further away than 39 bandwidths add nothing and are left out.
    """
    names = [f"k{j}" for j in range(len(keys))]
    told = values.where(F.col(value).isNotNull()).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(value).cast("double").alias("v"))
    m = told.groupBy(*names).agg(F.count("v").alias("n"), F.stddev_samp("v").alias("sd")).where("n >= 2 AND sd > 0")
    m = m.select(*names, "n", (F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-1 / 5))).alias("h"))
    both = told.alias("a").join(m.alias("b"), same_rows("a", "b", names)).select("a.*", "b.n", "b.h")
    near = both.where((F.col("v") > low - 39 * F.col("h")) & (F.col("v") < high + 39 * F.col("h")))
    cell = F.floor((F.col("v") - low) / (F.col("h") / 4))
    off = (F.col("v") - low) / F.col("h") - (F.col("cell") + 0.5) / 4
    # moments over factorials: t**j / j!
    term, moments = F.lit(1.0), []
    for j in range(order):
        term = term * off / j if j else term
        moments.append(F.sum(term).alias(f"_{j}"))
    cells = near.withColumn("cell", cell).groupBy(*names, "cell").agg(F.first("n").alias("n"), F.first("h").alias("h"), *moments)
    grid = [low + (high - low) * i / (points - 1) for i in range(points)]
    met = cells.select("*", F.posexplode(F.array(*map(F.lit, grid))).alias("i", "x"))
    met = met.withColumn("u", (F.col("x") - low) / F.col("h") - (F.col("cell") + 0.5) / 4)
    u, total, before, now = F.col("u"), F.col("_0"), F.lit(1.0), F.col("u")
    for j in range(1, order):
        total = total + now * F.col(f"_{j}")
        before, now = now, u * now - j * before
    made = met.select(*names, "i", "x", "n", "h", (F.exp(-0.5 * u * u) * total).alias("t")).groupBy(*names, "i", "x").agg((F.sum("t") / (F.first("n") * F.first("h") * (2 * math.pi) ** 0.5)).alias("density"))
    return made.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "i", "x", "density")


def summary_json(row: DataFrame) -> DataFrame:
    """Each row as a JSON text."""
    return row.select(F.to_json(F.struct(*row.columns)).alias("json"))
