"""Counts per sample, locus and group, and their filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from islet.functions.numeric import ratio, rounded

KEYS = ("sample", "island_id")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def haplotype_label(hp: Column) -> Column:
    """1 and 2 by name; absent and any other tag are unphased."""
    return F.when(hp == 1, "hap1").when(hp == 2, "hap2").otherwise("unphased")


def call_counts(calls: Column, threshold: Column | float, start: Column | None = None, end: Column | None = None) -> tuple[Column, Column]:
    """(total, methylated) of an array of struct<rpos, prob>, of the positions in [start, end) if given; resolved positions only."""
    inside = F.filter(calls, lambda c: c["rpos"].isNotNull() & ((c["rpos"] >= start) & (c["rpos"] < end) if start is not None else F.lit(True)))
    return F.size(inside).cast("long"), F.size(F.filter(inside, lambda c: c["prob"] >= threshold)).cast("long")


def rollup_counts(reads: DataFrame, *, keys: Sequence[str] = KEYS, group: str = "haplotype", total: str = "n_total", meth: str = "n_meth", attributes: Sequence[str] = (), all_label: str = "all") -> DataFrame:
    """Reads summed per keys and group, and per keys alone under ``all_label``, in one pass.

    A read is a row with ``total`` and ``meth`` calls; the fraction is call-weighted, to four places. Groups without any
    call are left out. ``attributes`` describe the keys and come along.
    """
    by = [*keys, *attributes]
    made = reads.groupingSets([[*by, group], by], *by, group).agg(
        F.grouping(group).alias("rolled"), F.count("*").alias("n_reads"), F.sum(total).cast("long").alias("n_cpg_total"), F.sum(meth).cast("long").alias("n_cpg_meth")
    )
    made = made.where("n_cpg_total > 0").withColumn(group, F.when(F.col("rolled") == 1, all_label).otherwise(F.col(group)))
    return made.select(*by, group, "n_reads", "n_cpg_total", "n_cpg_meth", (F.col("n_cpg_total") - F.col("n_cpg_meth")).alias("n_cpg_unmeth"), rounded(ratio(F.col("n_cpg_meth"), F.col("n_cpg_total")), 4).alias("frac_meth"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys that repeat, and rows beyond the first of each."""
    n = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return n.agg(F.count("*").alias("repeated_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("extra_rows"))


def depth_filter(counts: DataFrame, *, min_reads: int = 15, min_reads_hap: int = 8, min_cpg: int = 10, group: str = "haplotype", cpg: str | None = "island_cpgNum") -> DataFrame:
    """Enough reads (more for the rolled-up group) at loci with enough sites."""
    deep = ((F.col(group) == "all") & (F.col("n_reads") >= min_reads)) | ((F.col(group) != "all") & (F.col("n_reads") >= min_reads_hap))
    return counts.where(deep & (F.col(cpg) >= min_cpg) if cpg else deep)


def exclude_samples(counts: DataFrame, names: DataFrame, *, sample: str = "sample") -> DataFrame:
    """Rows of samples that aren't listed; ``names`` has the sample column."""
    return counts.join(names.select(sample).distinct(), sample, "left_anti")


def exclusion_audit(counts: DataFrame, names: DataFrame, *, sample: str = "sample") -> DataFrame:
    """(sample, found) of each listed name."""
    have = counts.select(sample).distinct().withColumn("found", F.lit(True))
    return names.select(sample).distinct().join(have, sample, "left").select(sample, F.coalesce("found", F.lit(False)).alias("found"))


def merge_counts(tables: Sequence[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def without_chromosomes(df: DataFrame, names: Sequence[str] = ("chrX", "chrY"), *, chrom: str = "chrom") -> DataFrame:
    """Rows of other chromosomes; a table without the column is as it was."""
    return df.where(~F.col(chrom).isin(*names)) if chrom in df.columns else df
