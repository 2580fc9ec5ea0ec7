"""``python -m islet.plans.cli count|qc|cohort|views|xci``: the runs from files to files."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from islet.functions.storage import keep
from islet.operators import views, xci
from islet.plans import runs
from islet.sources import tables


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="islet")
    sub = top.add_subparsers(dest="run", required=True)

    def run(name: str, *required: str, **options) -> None:
        p = sub.add_parser(name)
        for r in (*required, "outdir"):
            p.add_argument(f"--{r}", required=True)
        for o, default in options.items():
            p.add_argument(f"--{o}", default=default, **({"action": "store_true"} if default is False else {"type": type(default) if default is not None else str}))
        p.add_argument("--force", action="store_true")

    run("count", "bam_glob", "cpg_tsv", prob_cutoff=0.5, max_bams=1 << 30)
    run("qc", "counts", mahal_thresh=3.0, min_coverage_frac=0.5, meth_lo=0.1, meth_hi=0.9)
    run("cohort", "counts", exclude_samples=None, min_reads=15, min_reads_hap=8, min_cpg=10, min_samples=5, z_thresh=2.5, leave_one_out=False)
    run("views", "stats", locus_stats=None, outliers=None, top_loci=100, z_thresh=2.5, manhattan_hap="all", top_labels=3, no_per_sample=False, no_per_loci=False)
    run("xci", "bam_glob", "cpg_islands", prefix=None, min_cpg=10, meth_frac_thr=0.75, meth_prob_thr=128, min_reads_per_hap=8, hemi_low=0.40, hemi_high=0.60, phasing_mode="read_backed")
    return top


def bam(spark: SparkSession, path: str, most: int = 1 << 30, **options):
    from islet.sources.bam import BamSource

    spark.dataSource.register(BamSource)
    return spark.read.format("islet_bam").options(path=path, max_files=most, **options).load()


def count(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Counts of all samples; of indexed files only the chunks that may hold reads of the islands are read.

    A sample's counts are kept in the output folder by the file's size and time, the parameters and the islands' content.
    """
    from islet.sources.bam import listed, regions_text, sample_of

    files = listed(a.bam_glob)[: a.max_bams]
    if not files:
        raise ValueError(f"no alignment files: {a.bam_glob}")
    islands = tables.read_island_tsv(spark, a.cpg_tsv)
    # spans the index can tell apart: at most a genome's length over 16 kb
    region = regions_text((r.chrom, r.start, r.end) for r in islands.select("chrom", "start", "end").distinct().toLocalIterator())
    marks = tables.file_marks(spark, files).select(F.element_at(F.split("path", "/"), -1).alias("file"), "mark")
    inputs = spark.createDataFrame([(f.rsplit("/", 1)[-1], sample_of(f)) for f in files], "file string, sample string").join(marks, "file", "left")
    make = lambda samples: runs.count_reads(bam(spark, a.bam_glob, a.max_bams, samples="\t".join(samples), region=region), islands, prob_cutoff=a.prob_cutoff)
    params = {"prob_cutoff": a.prob_cutoff, "islands": tables.content_mark(islands)}
    return tables.stored_counts(inputs, f"{a.outdir}/store", params, make, force=a.force)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("islet").getOrCreate()
    save = lambda df, name: tables.write_tsv(df, f"{a.outdir}/{name}", force=a.force)
    if a.run == "count":
        save(count(spark, a), "all_samples_counts")
    elif a.run == "qc":
        table = tables.read_counts(spark, a.counts)
        coords = runs.embedding(table)
        flags = runs.qc_run(table, coords, mahal_thresh=a.mahal_thresh, min_coverage_frac=a.min_coverage_frac, meth_lo=a.meth_lo, meth_hi=a.meth_hi)
        save(flags, "sample_qc_metrics")
        save(views.qc_records(coords, flags), "qc_records")
        save(views.qc_bars(flags), "qc_bars")
        tables.write_exclude_list(flags, f"{a.outdir}/samples_exclude", source=a.counts, force=a.force)
    elif a.run == "cohort":
        out = tables.read_exclude_list(spark, a.exclude_samples) if a.exclude_samples else None
        stats, scored = runs.cohort_run(tables.read_counts(spark, a.counts), out, min_reads=a.min_reads, min_reads_hap=a.min_reads_hap, min_cpg=a.min_cpg, min_samples=a.min_samples, z_thresh=a.z_thresh, leave_one_out=a.leave_one_out)
        save(stats, "cohort_locus_stats")
        save(scored, "all_samples_stats")
        tables.write_in_order(tables.in_order(scored).where("outlier"), f"{a.outdir}/outliers", ["island_id", "haplotype", F.abs("z_score").desc_nulls_last(), "sample"], force=a.force)
    elif a.run == "views":
        made = runs.view_tables(*tables.read_scored(spark, a.stats, a.locus_stats, a.outliers), z_thresh=a.z_thresh, top_loci=a.top_loci, top_labels=a.top_labels, manhattan_hap=a.manhattan_hap, per_sample=not a.no_per_sample, per_loci=not a.no_per_loci)
        for name, df in made.items():
            save(df, name)
    else:
        # all samples of the glob together; every table has the sample as a column
        params = {k: getattr(a, k) for k in ("min_cpg", "meth_frac_thr", "meth_prob_thr", "min_reads_per_hap", "hemi_low", "hemi_high")}
        contigs = keep(bam(spark, a.bam_glob, table="contigs"))
        # file names: as many as the reader lists on the driver anyway
        samples = [r.sample for r in xci.sex_of(contigs).where("sex <> 'M'").select("sample").collect()]
        # without any, no file's reads: the tables are empty and only the summaries have rows
        reads = bam(spark, a.bam_glob, samples="\t".join(samples) or "\t", region="chrX")
        got = runs.xci_run(reads, tables.read_island_bed(spark, a.cpg_islands), min_cpg=a.min_cpg, meth_frac_thr=a.meth_frac_thr, meth_prob_thr=a.meth_prob_thr, min_reads=a.min_reads_per_hap, low=a.hemi_low, high=a.hemi_high)
        got |= {name: keep(got[name]) for name in ("per_read", "per_island", "hemi")}
        for name in ("per_read", "per_island"):
            save(got[name], name)
        tables.write_bed9(got["track"], f"{a.outdir}/track", prefix=a.prefix, force=a.force)
        plots = runs.xci_plots(got["hemi"])
        for name, df in plots.items():
            save(df, f"xci_{name}")
        told = runs.xci_summaries(contigs, got, plots["fits"], source=a.bam_glob, phasing_mode=a.phasing_mode, **params)
        told.select("sample", F.col("json").alias("value")).repartition("sample").write.mode("overwrite" if a.force else "ignore").partitionBy("sample").text(f"{a.outdir}/summary")


if __name__ == "__main__":
    main()
