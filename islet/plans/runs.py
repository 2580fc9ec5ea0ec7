"""The runs: reads to counts, counts to quality metrics and to cohort outliers, scored rows to plot tables, reads to inactivation bias."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.functions.numeric import rounded
from islet.functions.storage import keep
from islet.operators import cohort, counts, intervals, qc, views, xci
from islet.sources import tables


def count_reads(reads: DataFrame, islands: DataFrame, *, prob_cutoff: float = 0.5, bin_size: int = 100_000) -> DataFrame:
    """Counts per sample, island and haplotype of the reads that span an island; duplicates are kept."""
    spanning = intervals.span_join(counts_ready(reads, drop_duplicates=False), islands, bin_size=bin_size)
    total, meth = counts.call_counts(F.col("calls"), F.lit(int(prob_cutoff * 255)), F.col("start"), F.col("end"))
    told = spanning.withColumn("n_total", total).withColumn("n_meth", meth).where("n_total > 0").withColumn("haplotype", counts.haplotype_label(F.col("hp")))
    told = told.withColumnsRenamed({"start": "island_start", "end": "island_end"})
    return counts.rollup_counts(told, attributes=["island_name", "chrom", "island_start", "island_end", "island_cpgNum"])


def counts_ready(reads: DataFrame, *, drop_duplicates: bool) -> DataFrame:
    return xci.usable_reads(reads, drop_duplicates=drop_duplicates)


def cohort_run(table: DataFrame, excluded: DataFrame | None = None, *, min_reads: int = 15, min_reads_hap: int = 8, min_cpg: int = 10, min_samples: int = 5, z_thresh: float = 2.5, leave_one_out: bool = False, exclude_chroms: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(locus statistics, scored rows with flags) of a counts table."""
    rows = counts.without_chromosomes(table, exclude_chroms) if exclude_chroms else table
    rows = counts.exclude_samples(rows, excluded) if excluded is not None else rows
    rows = counts.depth_filter(rows, min_reads=min_reads, min_reads_hap=min_reads_hap, min_cpg=min_cpg)
    stats = keep(cohort.locus_stats(rows, min_samples=min_samples, attributes=["island_name", "chrom", "island_start", "island_end", "island_cpgNum"]))
    scored = cohort.score_leave_one_out(rows, min_samples=min_samples) if leave_one_out else cohort.score_standard(rows, stats)
    return stats, tables.in_order(cohort.add_pvalues_and_flags(scored, z_thresh=z_thresh))


def embedding(table: DataFrame) -> DataFrame:
    """Principal components of the samples of a counts table, by their rolled-up rows; sex chromosomes are left out."""
    return qc.principal_components(qc.median_imputed(counts.without_chromosomes(table).where("haplotype = 'all'")))


def qc_run(table: DataFrame, coords: DataFrame | None = None, *, mahal_thresh: float = 3.0, min_coverage_frac: float = 0.5, meth_lo: float = 0.1, meth_hi: float = 0.9) -> DataFrame:
    """Sample metrics with the embedding distance and the flags; sex chromosomes are left out."""
    far = qc.mahalanobis(embedding(table) if coords is None else coords).select("sample", rounded(F.col("mahal_dist"), 3).alias("mahal_dist"))
    metrics = qc.sample_metrics(counts.without_chromosomes(table)).join(far, "sample", "left")
    return qc.qc_flags(metrics, mahal_thresh=mahal_thresh, min_coverage_frac=min_coverage_frac, meth_lo=meth_lo, meth_hi=meth_hi)


def xci_run(reads: DataFrame, islands: DataFrame, *, min_cpg: int = 10, meth_frac_thr: float = 0.75, meth_prob_thr: int = 128, min_reads: int = 8, low: float = 0.40, high: float = 0.60) -> dict[str, DataFrame]:
    """per_read, per_island, track and hemi tables of reads across the islands outside the pseudoautosomal regions; duplicates are dropped."""
    outside, par = intervals.split_par(islands)
    spanning = intervals.span_join(counts_ready(reads, drop_duplicates=True), outside, bin_size=100_000)
    total, meth = counts.call_counts(F.col("calls"), F.lit(meth_prob_thr), F.col("start"), F.col("end"))
    told = spanning.withColumn("n_cpg", total).withColumn("n_cpg_meth", meth).where(F.col("n_cpg") >= min_cpg)
    per_read = told.select(
        "sample", "read_id", F.coalesce("hp", F.lit(0)).alias("haplotype"), F.col("name").alias("island_id"), F.col("chrom").alias("island_chrom"), F.col("start").alias("island_start"), F.col("end").alias("island_end"),
        "n_cpg", "n_cpg_meth", (F.col("n_cpg") - F.col("n_cpg_meth")).alias("n_cpg_unmeth"), xci.rounded(xci.ratio(F.col("n_cpg_meth"), F.col("n_cpg")), 4).alias("meth_fraction"), xci.classify_read(F.col("n_cpg_meth"), F.col("n_cpg"), meth_frac_thr).alias("classification"),
    )
    per_island = xci.per_island(per_read, ("sample", *xci.ISLAND))
    every = outside.select(F.col("name").alias("island_id"), F.col("chrom").alias("island_chrom"), F.col("start").alias("island_start"), F.col("end").alias("island_end"))
    # a track has every island of every sample: that many rows by definition
    samples = reads.select("sample").distinct()
    told = every.crossJoin(samples).join(per_island, ["sample", *xci.ISLAND], "left")
    track = xci.bed9(xci.island_status(told, min_reads=min_reads, low=low, high=high), par.crossJoin(samples), keys=["sample"])
    return {"islands": every, "per_read": per_read, "per_island": per_island, "track": track, "hemi": xci.hemi_methylated(per_island, min_reads=min_reads, low=low, high=high)}


def xci_summary(sample: str, source: str, contigs: DataFrame, got: dict[str, DataFrame] | None, *, phasing_mode: str = "read_backed", **params) -> dict:
    """The summary of one sample: its sex by contigs, and unless it is male, what was kept and the bias by mode.

    Medians and means are percentages, biases are parts. For a male ``got`` (the tables of ``xci_run``) isn't looked at; ``params`` are
    the run's parameters, which are told as they are. Unknown numbers are null.
    """
    known = lambda x, places: None if x is None else math.floor(float(x) * 10.0**places + 0.5) / 10.0**places
    sex = xci.sex_of(contigs.where(F.col("sample") == sample)).first()
    head = {"sample": sample, "bam": source, "inferred_sex": sex.sex if sex else "unknown", "sex_check_n_chrx_sampled": sex.x_reads if sex else 0, "sex_check_n_chry_sampled": sex.y_reads if sex else 0, "sex_check_chry_frac": known(sex.y_ratio, 3) if sex else None}
    tail = {"params": params}
    if head["inferred_sex"] == "M":
        return head | {"phasing_mode": phasing_mode} | tail
    hemi, islands = got["hemi"].where(F.col("sample") == sample), got["per_island"].where(F.col("sample") == sample)
    enough = [F.col(f"n_meth_{h}") + F.col(f"n_unmeth_{h}") >= params.get("min_reads_per_hap", 8) for h in ("hap1", "hap2")]
    # parts have four places: whole ten-thousandths add up the same in any order
    whole = {h: F.round(F.col(f"meth_frac_{h}") * 1e4).cast("long") for h in ("hap1", "hap2")}
    middles = [F.median(F.col(f"meth_frac_{h}") * 100).alias(f"meth_frac_{h}_median") for h in whole]
    means = [(F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double")) / 100).alias(f"meth_frac_{h}_mean") for h, x in whole.items()]
    sides = hemi.agg(F.count("*").alias("n"), *middles, *means).first()
    body = {"n_islands_nonPAR": got["islands"].count(), "n_reads_retained": got["per_read"].where(F.col("sample") == sample).count(), "n_islands_sufficient_coverage": islands.where(enough[0] & enough[1]).count(), "n_islands_hemi_methylated": sides.n}
    body |= {c: known(sides[c], 4) for c in sides.asDict() if c != "n"} | {"phasing_mode": phasing_mode}
    if phasing_mode == "pedigree":
        return head | body | {k: known(v, 4) for k, v in xci.bias_pedigree(hemi).first().asDict().items()} | tail
    fit = xci.gaussian_mixture(views.haplotype_percentages(hemi).where("series = 'combined'"))
    bias = {"xci_bias": xci.bias_read_backed(fit), "gmm_peak_low": fit["mean_low"], "gmm_peak_high": fit["mean_high"]} if fit else {"xci_bias": None, "gmm_peak_low": None, "gmm_peak_high": None}
    return head | body | {k: known(v, 4 if k == "xci_bias" else 2) for k, v in bias.items()} | tail


def xci_plots(hemi: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the inactivation plots of every sample: scatter, densities and histogram of the percentages, the mixture's fit
    to both haplotypes' percentages together, and its curves over the last two."""
    pct = views.haplotype_percentages(hemi, keys=["sample"])
    fits = keep(xci.gaussian_mixtures(pct.where("series = 'combined'"), ["sample"]))
    scatter = views.xci_scatter(hemi, keys=["sample"])
    return {"scatter": scatter, "distribution": views.xci_distribution(hemi, keys=["sample"]), "histogram": views.xci_histogram(hemi, keys=["sample"]), "fits": fits, "overlays": views.mixture_overlays(fits, keys=["sample"])}


def xci_summaries(contigs: DataFrame, got: dict[str, DataFrame], fits: DataFrame | None = None, *, source: str = "", phasing_mode: str = "read_backed", **params) -> DataFrame:
    """(sample, inferred_sex, json): ``xci_summary`` of every sample of ``contigs``, in grouped passes over the tables of ``xci_run`` of all.

    ``fits``: mixtures by sample, where they are known already. A male's summary ends with its sex.
    """
    known = lambda x, places: rounded(x, places)
    told = xci.sex_of(contigs).select("sample", F.lit(source).alias("bam"), F.col("sex").alias("inferred_sex"), F.col("x_reads").alias("sex_check_n_chrx_sampled"), F.col("y_reads").alias("sex_check_n_chry_sampled"), known(F.col("y_ratio"), 3).alias("sex_check_chry_frac"))
    clear = lambda h: F.col(f"n_meth_{h}") + F.col(f"n_unmeth_{h}") >= params.get("min_reads_per_hap", 8)
    reads = got["per_read"].groupBy("sample").agg(F.count("*").alias("n_reads_retained"))
    deep = got["per_island"].groupBy("sample").agg(F.count(F.when(clear("hap1") & clear("hap2"), 1)).alias("n_islands_sufficient_coverage"))
    whole = {h: F.round(F.col(f"meth_frac_{h}") * 1e4).cast("long") for h in ("hap1", "hap2")}
    middles = [known(F.median(F.col(f"meth_frac_{h}") * 100), 4).alias(f"meth_frac_{h}_median") for h in whole]
    means = [known(F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double")) / 100, 4).alias(f"meth_frac_{h}_mean") for h, x in whole.items()]
    biases = [known(F.percentile(f"meth_frac_{h}", 0.5), 4).alias(f"xci_bias_{h}") for h in whole]
    hemi = got["hemi"].groupBy("sample").agg(F.count("*").alias("n_islands_hemi_methylated"), *middles, *means, *biases)
    for more in (reads, deep, hemi):
        told = told.join(more, "sample", "left")
    told = told.withColumn("n_islands_nonPAR", F.lit(got["islands"].count()))
    if phasing_mode == "pedigree":
        bias = ["xci_bias_hap1", "xci_bias_hap2"]
    else:
        fits = xci.gaussian_mixtures(views.haplotype_percentages(got["hemi"], keys=["sample"]).where("series = 'combined'"), ["sample"]) if fits is None else fits
        low, high = F.col("mean_low"), F.col("mean_high")
        fit = fits.select("sample", known((low / 100 + 1 - high / 100) / 2, 4).alias("xci_bias"), known(low, 2).alias("gmm_peak_low"), known(high, 2).alias("gmm_peak_high"))
        told, bias = told.join(fit, "sample", "left"), ["xci_bias", "gmm_peak_low", "gmm_peak_high"]
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    head = ["sample", "bam", "inferred_sex", "sex_check_n_chrx_sampled", "sex_check_n_chry_sampled", "sex_check_chry_frac"]
    body = ["n_islands_nonPAR", *map(zero, ("n_reads_retained", "n_islands_sufficient_coverage", "n_islands_hemi_methylated")), *[f"meth_frac_{h}_{x}" for x in ("median", "mean") for h in whole]]
    mode, tail = F.lit(phasing_mode).alias("phasing_mode"), F.struct(*[F.lit(v).alias(k) for k, v in params.items()]).alias("params") if params else F.create_map().cast("map<string,string>").alias("params")
    text = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    return told.select("sample", "inferred_sex", F.when(F.col("inferred_sex") == "M", text(*head, mode, tail)).otherwise(text(*head, *body, mode, *bias, tail)).alias("json"))


def view_tables(flagged: DataFrame, stats: DataFrame | None = None, outliers: DataFrame | None = None, *, z_thresh: float = 2.5, top_loci: int = 100, top_labels: int = 3, manhattan_hap: str = "all", per_sample: bool = True, per_loci: bool = True) -> dict[str, DataFrame]:
    """The tables behind the plots by name, of scored rows (and, where given, locus statistics and outliers); sex chromosomes are left out.

    Per-sample and per-locus tables hold all samples and loci in one pass, with their key as a column.
    """
    chroms = intervals.chrom_table(flagged.sparkSession)
    flagged = counts.without_chromosomes(flagged)
    outliers = counts.without_chromosomes(outliers) if outliers is not None else flagged.where("outlier")
    sides = views.haplotypes_side_by_side(flagged)
    imputed = keep(qc.median_imputed(flagged.where("haplotype = 'all'")))
    axes = qc.principal_components(imputed)
    made = {
        "manhattan_outlier_count": views.manhattan(outliers, chroms), "outlier_scatter": views.deviating(flagged, z_thresh=z_thresh), "heatmap_outliers": views.heatmap(flagged, most=top_loci),
        "methylation_embedding": views.embedding_table(axes, views.sample_summary(flagged)), "embedding_shares": qc.axis_shares(imputed, axes=axes),
        "manhattan_by_haplotype": views.manhattan_by_haplotype(outliers, chroms), "haplotypic_delta_manhattan": views.haplotypic_delta_manhattan(sides, flagged, chroms),
    }
    if stats is not None:
        stats = counts.without_chromosomes(stats)
        made["locus_methylation_ordered"] = views.ordered_loci(stats.where("haplotype = 'all'"), chroms)
        made["locus_distributions"] = views.locus_distributions(stats)
    if per_sample:
        made |= {"sample_volcano": views.volcano(flagged), "sample_hap1_vs_hap2": sides, "sample_manhattan": views.sample_manhattan_points(flagged, chroms, z_thresh=z_thresh, top_labels=top_labels, haplotype=manhattan_hap)}
    if per_loci:
        made |= {"loci": views.loci_in_order(flagged, chroms), "locus_boxes": views.box_summary(flagged, ["island_id", "haplotype"], "frac_meth", few_values=True)}
    return made
