"""Sample quality metrics, embedding distance and flags."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from islet.functions.numeric import flag, ratio, rounded
from islet.functions.storage import keep


def sample_metrics(counts: DataFrame) -> DataFrame:
    """Per sample, over its rolled-up rows: loci, mean, median and deviation of fractions, reads; share of all loci; loci of each haplotype.

    All loci are those of any row. Samples without rolled-up rows have no metrics; a sample without loci of a haplotype has null
    for it.
    """
    every = counts.agg(F.count_distinct("island_id")).scalar()
    of = lambda hap, c: F.when(F.col("haplotype") == hap, F.col(c))
    whole = F.round(of("all", "frac_meth") * 1e4).cast("long")
    n, s, q = F.count(whole), F.sum(whole), F.sum(whole * whole)
    var = F.try_divide(q.cast("double") - s.cast("double") * s.cast("double") / F.nullif(n, F.lit(0)), (n - 1).cast("double")) / 1e8
    made = counts.groupBy("sample").agg(
        F.count_distinct(of("all", "island_id")).alias("n_loci_covered"),
        rounded(F.try_divide(s.cast("double"), n.cast("double")) / 1e4, 4).alias("mean_meth"),
        rounded(F.percentile(of("all", "frac_meth"), 0.5), 4).alias("median_meth"),
        rounded(F.sqrt(F.when(n > 1, F.greatest(var, F.lit(0.0)))), 4).alias("std_meth"),
        rounded(F.avg(of("all", "n_reads")), 4).alias("mean_reads"),
        rounded(F.percentile(of("all", "n_reads"), 0.5), 4).alias("median_reads"),
        F.nullif(F.count_distinct(of("hap1", "island_id")), F.lit(0)).alias("n_hap1_loci"),
        F.nullif(F.count_distinct(of("hap2", "island_id")), F.lit(0)).alias("n_hap2_loci"),
    )
    made = made.where("n_loci_covered > 0").withColumn("n_loci_total", every.cast("long"))
    return made.withColumn("coverage_frac", rounded(ratio(F.col("n_loci_covered"), F.col("n_loci_total")), 4))


def qc_flags(metrics: DataFrame, *, mahal_thresh: float = 3.0, min_coverage_frac: float = 0.5, meth_lo: float = 0.1, meth_hi: float = 0.9) -> DataFrame:
    """Adds flag_embedding, flag_coverage, flag_meth, qc_outlier and qc_reasons; unknown values raise no flag.

    The reasons' words are fixed values.
    """
    far = flag(rounded(F.col("mahal_dist"), 3) > mahal_thresh) if "mahal_dist" in metrics.columns else F.lit(False)
    made = metrics.withColumn("flag_embedding", far).withColumn("flag_coverage", flag(F.col("coverage_frac") < min_coverage_frac))
    made = made.withColumn("flag_meth", flag((F.col("mean_meth") < meth_lo) | (F.col("mean_meth") > meth_hi)))
    made = made.withColumn("qc_outlier", F.col("flag_embedding") | F.col("flag_coverage") | F.col("flag_meth"))
    reasons = [F.when(F.col(f"flag_{k}"), F.lit(text)) for k, text in (("embedding", "embedding_outlier"), ("coverage", "low_coverage"), ("meth", "atypical_methylation"))]
    return made.withColumn("qc_reasons", F.concat_ws(" ", *reasons))


def median_imputed(counts: DataFrame, *, value: str = "frac_meth", sample: str = "sample", locus: str = "island_id") -> DataFrame:
    """(sample, locus, value, imputed) for every sample at every locus with a value; what is missing gets the locus's median.

    The grid is every sample at every locus by definition: the product of the tables of loci and of samples.
    """
    known = counts.where(F.col(value).isNotNull()).groupBy(locus, sample).agg(F.avg(value).alias("v"))
    middle = known.groupBy(locus).agg(F.percentile("v", 0.5).alias("middle"))
    grid = middle.crossJoin(counts.select(sample).distinct())
    both = grid.join(known, [locus, sample], "left")
    return both.select(sample, locus, F.coalesce("v", "middle").alias(value), F.col("v").isNull().alias("imputed"))


def axis_shares(imputed: DataFrame, *, value: str = "frac_meth", sample: str = "sample", locus: str = "island_id", k: int = 2, axes: DataFrame | None = None) -> DataFrame:
    """(axis, share): what part of the variance of the standardised loci the first axes carry: of each axis, its coordinates' squares.

    ``axes``: the principal components, where they are known already.
    """
    axes = principal_components(imputed, value=value, sample=sample, locus=locus, k=k) if axes is None else axes
    spread = imputed.groupBy(locus).agg(F.stddev_pop(value).alias("sd"), F.count("*").alias("n"))
    total = spread.agg(F.sum(F.when(F.col("sd") > 0, F.col("n")).otherwise(0)).cast("double")).scalar()
    names = [f"pc{i + 1}" for i in range(k)]
    sums = axes.agg(*[F.sum(F.col(n) * F.col(n)).alias(n) for n in names])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(n).alias("axis"), F.col(n).alias("s")) for n in names])).alias("a")).select("a.axis", ratio(F.col("a.s"), total).alias("share"))


def _times(cells: DataFrame, by: str, over: str, vectors: DataFrame, width: int) -> DataFrame:
    """(by, y): the product of a matrix in cells (by, over, x) with a thin one in rows (over, y array): a join and sums, pre-aggregated."""
    met = cells.join(vectors, over)
    sums = [F.sum(F.col("x") * F.get("y", F.lit(j))).alias(f"_{j}") for j in range(width)]
    return met.groupBy(by).agg(*sums).select(by, F.array(*[f"_{j}" for j in range(width)]).alias("y"))


def _inner(vectors: DataFrame, width: int) -> np.ndarray:
    """The products of a thin matrix's columns with each other: summed within tasks, so that a task sends one small matrix."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            y = b.column("y").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], names=["at", "g"])

    cells = vectors.select("y").mapInArrow(work, "at long, g double").groupBy("at").agg(F.sum("g").alias("g")).collect()
    out = np.zeros(width * width)
    for r in cells:
        out[r.at] = r.g
    return out.reshape(width, width)


def _turned(vectors: DataFrame, by: str, turn: np.ndarray) -> DataFrame:
    """Each row of a thin matrix times a small one."""
    column = lambda j: F.aggregate(F.zip_with("y", F.array(*map(F.lit, turn[:, j].tolist())), lambda a, b: a * b), F.lit(0.0), lambda s, a: s + a)
    return vectors.select(by, F.array(*[column(j) for j in range(turn.shape[1])]).alias("y"))


def _orthonormal(vectors: DataFrame, by: str, width: int) -> DataFrame:
    """The same span with orthonormal columns; directions that carry nothing become zero."""
    values, axes = np.linalg.eigh(_inner(vectors, width))
    good = values > values.max(initial=0.0) * 1e-13
    return _turned(vectors, by, axes * np.where(good, 1 / np.sqrt(np.where(good, values, 1.0)), 0.0))


def principal_components(imputed: DataFrame, *, value: str = "frac_meth", sample: str = "sample", locus: str = "island_id", k: int = 2, more: int = 24, rounds: int = 30, tolerance: float = 1e-10) -> DataFrame:
    """(sample, pc1, pc2, ...) of the samples over standardised loci (zero variance: unit scale), by a randomised range finder.

    The matrix stays a table of cells. It is multiplied with k + ``more`` random signs a locus, and then by turns with its transpose and
    itself, until the leading eigenvalues move by less than ``tolerance`` of themselves (after ``rounds`` rounds at the latest): each
    product is a join and a pre-aggregated sum. Only products of the thin matrices' columns, k + ``more`` squared numbers, reach
    the driver, so samples and loci may both be many; where one of them is no more than k + ``more``, the first round is exact and the only one.
    Signs are set so that the largest coordinate of each axis is positive. Under three samples: no rows. Null samples or loci don't count.
    """
    spark, kind = imputed.sparkSession, imputed.schema[sample].dataType.simpleString()
    names, width = [f"pc{i + 1}" for i in range(k)], k + more
    cells = imputed.select(F.col(sample).alias("s"), F.col(locus).alias("l"), F.col(value).cast("double").alias("v")).where("s IS NOT NULL AND l IS NOT NULL")
    scale = cells.groupBy("l").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd"))
    x = (F.col("v") - F.col("mean")) / F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0)
    cells = keep(cells.join(scale, "l").select("s", "l", x.alias("x")))
    sides = [cells.select(c).distinct().limit(width + 1).count() for c in ("s", "l")]
    if sides[0] < 3:
        return spark.createDataFrame([], ", ".join([f"{sample} {kind}", *[f"{n} double" for n in names]]))
    sign = lambda j: F.when(F.xxhash64("l", F.lit(j)) % 2 == 0, 1.0).otherwise(-1.0)
    loci = cells.select("l").distinct().select("l", F.array(*[sign(j) for j in range(width)]).alias("y"))
    before = None
    for _ in range(1 if min(sides) <= width else rounds):
        left = keep(_orthonormal(keep(_times(cells, "s", "l", loci, width)), "s", width))
        right = keep(_times(cells, "l", "s", left, width))
        values, axes = np.linalg.eigh(_inner(right, width))
        top = np.maximum(values[::-1][:k], 0)
        if before is not None and np.all(np.abs(top - before) <= tolerance * max(top[0], 1e-300)):
            break
        before, loci = top, keep(_orthonormal(right, "l", width))
    turn = axes[:, ::-1][:, :k] * np.sqrt(top)
    coords = _turned(left, "s", turn).select("s", *[F.get("y", F.lit(i)).alias(n) for i, n in enumerate(names)])
    far = coords.agg(*[F.max_by(n, F.abs(n)).alias(n) for n in names]).first()
    return coords.select(F.col("s").alias(sample), *[(F.col(n) * (-1.0 if far[n] < 0 else 1.0)).alias(n) for n in names])


def mahalanobis(coords: DataFrame, x: str = "pc1", y: str = "pc2", *, out: str = "mahal_dist") -> DataFrame:
    """Distance of each point to the mean by the sample covariance; of a degenerate one, by each axis's own deviation; under three points, zero."""
    m = coords.agg(F.count("*").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.var_samp(x).alias("vx"), F.var_samp(y).alias("vy"), F.covar_samp(x, y).alias("c")).first()
    if m.n < 3:
        return coords.withColumn(out, F.lit(0.0))
    dx, dy = F.col(x) - m.mx, F.col(y) - m.my
    det = m.vx * m.vy - m.c * m.c
    if det > 1e-12 * max(m.vx * m.vy, 1e-300):
        square: Column = (dx * dx * m.vy - 2.0 * dx * dy * m.c + dy * dy * m.vx) / det
    else:
        square = dx * dx / (m.vx or 1.0) + dy * dy / (m.vy or 1.0)
    return coords.withColumn(out, F.sqrt(F.greatest(square, F.lit(0.0))))
