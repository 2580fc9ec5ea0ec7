"""More queries on the star-schema tables: plot tables, read filters, summaries, and tables written to files and read again. Each has its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from islet.functions.numeric import rounded
from islet.operators import cohort, counts, intervals, qc, ranks, views, xci
from islet.plans import cli, runs
from islet.queries import CALLS, COMPONENTS, COUNTS, KEY, KEYS, METRICS, PVALUES, R4, RENAMED, ROUND, STAT_COLS, STATS, _chrom_rows, _counts, _deep, _flagged, _flagged_of, _island_sql, _islands, _reads, _renamed, _t, r8, s8
from islet.queries import ORACLE as FIRST
from islet.sources import tables
from islet.sources.bam import regions_text
from islet.sources.bam_write import write_reads
from islet.streaming.incremental import CohortStates

ATTRIBUTES = ("island_name", "chrom", "island_start", "island_end", "island_cpgNum")
KEPT = dict(min_reads=5, low=0.3, high=0.7)


def _placed(df: DataFrame) -> DataFrame:
    """Brands as islands: a name (some have none), a chromosome (the last isn't one of the genome), a place and sites."""
    k = F.substring("island_id", 7, 9).cast("long")
    chrom = F.when(k <= 22, k.cast("string")).when(k == 23, "X").when(k == 24, "Y").otherwise("Un")
    name = F.when(k % 5 != 0, F.concat(F.lit("brand "), k.cast("string"), F.repeat(F.lit("x"), k.cast("int"))))
    return df.select("*", name.alias("island_name"), F.concat(F.lit("chr"), chrom).alias("chrom"), (k * 1000).alias("island_start"), (k * 1001 + 300).alias("island_end"), k.alias("island_cpgNum"))


def _place(table: str) -> str:
    return f"""(SELECT * EXCLUDE (k), CASE WHEN k % 5 <> 0 THEN 'brand ' || k || repeat('x', k) END AS island_name, 'chr' || CASE WHEN k <= 22 THEN CAST(k AS VARCHAR) WHEN k = 23 THEN 'X' WHEN k = 24 THEN 'Y' ELSE 'Un' END AS chrom,
 k * 1000 AS island_start, k * 1001 + 300 AS island_end, k AS "island_cpgNum" FROM (SELECT *, CAST(substring(island_id, 7) AS BIGINT) AS k FROM {table}))"""


GENOME = f"c(chrom, ord, o) AS (VALUES {_chrom_rows})"
X_POS = "o + (island_start + island_end) // 2"
PLACED = f"{PVALUES}, {GENOME}, placed AS {_place('flagged')}"


def _chroms(spark: SparkSession) -> DataFrame:
    return intervals.chrom_table(spark)


def manhattan_positions(spark, d):
    return views.manhattan(_placed(_flagged(spark, d)), _chroms(spark)).select("island_id", "chrom", "ord", "x_pos", "n_outliers", "mean_z", "size")


def manhattan_by_haplotype(spark, d):
    return views.manhattan_by_haplotype(_placed(_flagged(spark, d)), _chroms(spark), most=20).select(*KEY, "chrom", "x_pos", "z_score", "odd_chrom")


def hap_delta_manhattan(spark, d):
    table = _placed(_renamed(spark, d))
    return views.haplotypic_delta_manhattan(views.haplotypes_side_by_side(table), table, _chroms(spark)).select("island_id", "chrom", "x_pos", r8("mean_delta"), "size")


def sample_manhattan_points(spark, d):
    made = views.sample_manhattan_points(_placed(_flagged(spark, d)), _chroms(spark), z_thresh=2.0)
    return made.select(*KEY, "chrom", "x_pos", "z_score", rounded(F.col("signed_logp"), 6).alias("signed_logp"), "size", "label")


def smallest_p(spark, d):
    return views.smallest_p(_flagged(spark, d)).select(*KEY, "z_score", r8("p_value"), F.col("rank").cast("long").alias("rank"))


def _placed_stats(spark, d):
    return cohort.locus_stats(_placed(_deep(spark, d)), attributes=ATTRIBUTES)


def locus_distributions(spark, d):
    return views.locus_distributions(_placed_stats(spark, d), bins={"island_size": (300.0, 330.0, 10), "island_cpgNum": (0.0, 26.0, 13), "cohort_mean": (0.0, 1.0, 50)}).select("panel", "bin", "n")


def locus_distributions_whole(spark, d):
    """Over each panel's own range: every rolled-up locus is in a bin of each."""
    return views.locus_distributions(_placed_stats(spark, d)).select("panel", "bin", "n", r8("low"), r8("high"))


def price_histogram(spark, d):
    """Prices of each return flag over their own range."""
    return views.histogram(_t(spark, d, "lineitem"), "l_extendedprice", bins=20, keys=["l_returnflag"]).select("l_returnflag", "bin", "n", rounded(F.col("low"), 4).alias("low"), rounded(F.col("high"), 4).alias("high"))


def largest_orders(spark, d):
    """The 2000 dearest orders of each priority: more than a window's group limit takes."""
    top = ranks.first_per_group(_t(spark, d, "orders"), ["o_orderpriority"], F.col("o_totalprice"), ["o_orderkey"], 2000)
    return top.select("o_orderpriority", "o_orderkey", F.col("rank").cast("long").alias("rank"))


def price_quantiles(spark, d):
    """Quantiles of prices by supplier's nation, narrowed in rounds down to intervals of a thousand rows."""
    line = _t(spark, d, "lineitem").join(_t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    made = ranks.exact_quantiles(line, ["s_nationkey"], "l_extendedprice", (0.01, 0.5, 0.999), rows=1000)
    return made.select("s_nationkey", "n", *[rounded(F.get("q", F.lit(i)), 4).alias(c) for i, c in enumerate(("q01", "q50", "q999"))])


def stats_headline(spark, d):
    return views.headline(_placed_stats(spark, d))


def locus_boxes(spark, d):
    made = views.box_summary(_deep(spark, d), ["island_id", "haplotype"], "frac_meth", few_values=True)
    return made.select("island_id", "haplotype", "n", *[r8(c) for c in ("low", "q25", "median", "q75", "high")])


def first_per_locus(spark, d):
    return views.first_per_locus(_placed(_counts(spark, d)))


def loci_in_order(spark, d):
    return views.genome_sorted(views.loci_in_order(_placed(_counts(spark, d)), _chroms(spark))).select("island_id", "chrom", "ord")


def _qc(spark, d):
    metrics = qc.sample_metrics(_renamed(spark, d)).withColumn("mahal_dist", F.col("sample") % 7 / 2.0)
    return qc.qc_flags(metrics, mahal_thresh=2.0, min_coverage_frac=0.99, meth_lo=0.45, meth_hi=0.6)


def qc_records(spark, d):
    metrics = _qc(spark, d)
    coords = metrics.select("sample", F.col("mean_meth").alias("pc1"), F.col("mean_reads").alias("pc2"))
    return views.qc_records(coords, metrics.where("sample % 5 <> 0"))


def qc_bars(spark, d):
    return views.qc_bars(_qc(spark, d))


def embedding_samples(spark, d):
    coords = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("sample"), F.col("s_acctbal").alias("pc1"))
    return views.embedding_table(coords, views.sample_summary(_flagged(spark, d).where("sample % 3 <> 0")))


def spread_limits(spark, d):
    return views.spread_limit(_flagged(spark, d)).select(rounded(F.col("cmax"), 6).alias("cmax"))


def _hemi(spark, d):
    return xci.hemi_methylated(_islands(spark, d), **KEPT)


def xci_scatter(spark, d):
    return views.xci_scatter(_hemi(spark, d)).select("island_id", r8("hap1_pct"), r8("hap2_pct"), r8("abs_delta"))


def haplotype_percentages(spark, d):
    return views.haplotype_percentages(_hemi(spark, d)).select("series", r8("pct"))


def xci_distribution(spark, d):
    return views.xci_distribution(_hemi(spark, d), points=51).select("series", "i", rounded(F.col("density"), 8).alias("density"))


def xci_histogram(spark, d):
    return views.xci_histogram(_hemi(spark, d), bins=20)


def normal_overlay(spark, d):
    fit = {"weight_low": 0.4, "mean_low": 25.0, "sd_low": 10.0, "weight_high": 0.6, "mean_high": 75.0, "sd_high": 12.5}
    grid = _t(spark, d, "part").select(F.col("p_size").cast("double").alias("x")).distinct()
    return views.normal_overlay(grid, fit, n=100.0, width=2.0).select("x", "component", r8("density"))


def _sizes(spark, d):
    """Percentages by brand."""
    return _t(spark, d, "part").select("p_brand", (F.col("p_size") * 2.0).alias("pct"))


def gmm_by_brand(spark, d):
    """Mixtures of all brands at once."""
    return xci.gaussian_mixtures(_sizes(spark, d), ["p_brand"], rounds=40).select("p_brand", "n", *[rounded(F.col(f"{c}_{s}"), 6).alias(f"{c}_{s}") for s in ("low", "high") for c in ("weight", "mean", "sd")])


def mixture_overlays(spark, d):
    """The curves of each brand's mixture over its distribution and its histogram."""
    made = views.mixture_overlays(xci.gaussian_mixtures(_sizes(spark, d), ["p_brand"], rounds=40), keys=["p_brand"], points=21)
    return made.select("p_brand", "plot", "component", "i", rounded(F.col("y"), 6).alias("y"))


def kde_by_brand(spark, d):
    return xci.kde(_sizes(spark, d), keys=["p_brand"], points=101).select("p_brand", "i", rounded(F.col("density"), 8).alias("density"))


def qc_run(spark, d):
    """The whole quality run: metrics, distances in the embedding, flags and reasons."""
    made = runs.qc_run(_renamed(spark, d), mahal_thresh=2.0, min_coverage_frac=0.99, meth_lo=0.45, meth_hi=0.6)
    return made.select("sample", "coverage_frac", "mean_meth", "mahal_dist", "flag_embedding", "flag_coverage", "flag_meth", "qc_outlier", "qc_reasons")


def axis_shares(spark, d):
    """What the first two axes carry of the variance."""
    return qc.axis_shares(qc.median_imputed(_counts(spark, d).where("haplotype = 'all'"))).select("axis", rounded(F.col("share"), 8).alias("share"))


def incremental_cohort(spark, d):
    """Locus statistics that grew by three batches, the second of which came twice and the third with rows of the first; compacted between."""
    states, deep = CohortStates(spark, tables.scratch(spark)), _deep(spark, d)
    for number, part in enumerate((0, 1, 1, 2)):
        states.add(deep.where((F.col("sample") % 3 == part) | ((part == 2) & (F.col("sample") % 6 == 0))), number)
        if number == 2:
            states.compact(number)
    return states.stats().select("island_id", "haplotype", "cohort_n_samples", *map(r8, STAT_COLS))


def outliers_in_order(spark, d):
    """Outliers with their place: by locus, group and falling |z|."""
    made = intervals.ranked(_flagged(spark, d).where("outlier"), ["island_id", "haplotype", F.abs("z_score").desc_nulls_last(), "sample"])
    return made.select(*KEY, "z_score", F.col("rank").cast("long").alias("rank"))


def loci_on_genome(spark, d):
    """Loci with their place on the genome."""
    made = intervals.ranked(views.loci_in_order(_placed(_counts(spark, d)), _chroms(spark)), ["ord", "island_start", "island_id"])
    return made.select("island_id", "ord", "island_start", F.col("rank").cast("long").alias("rank"))


def track_in_order(spark, d):
    """The lines of a track with their place, as files hold them."""
    return intervals.ranked(track_rows(spark, d), ["start", F.desc("is_par"), "line"]).select("line", F.col("rank").cast("long").alias("rank"))


def _alignments(spark, d):
    """Alignment files of four samples, written from the embeddings: each is a read of 64 C with their calls, a clip in front and an insertion within."""
    v = F.col("vec_id")
    flag = F.when(v % 11 == 0, 4).otherwise(0) + F.when(v % 3 == 0, 16).otherwise(0) + F.when(v % 7 == 0, 256).otherwise(0) + F.when(v % 5 == 0, 1024).otherwise(0)
    calls = F.transform("embedding", lambda e: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((e.cast("double") + 1) * 120).cast("int"))))
    rows = _t(spark, d, "embeddings").select(
        F.concat(F.lit("s"), (v % 4).cast("string")).alias("sample"), F.concat(F.lit("r"), v.cast("string")).alias("read_id"), flag.alias("flag"), F.when(v % 2 == 0, "chr1").otherwise("chrX").alias("chrom"),
        (v % 50 * 40_000 + v % 7 + v % 2 * 3_000_000).alias("pos"), F.lit("4S60M2I62M").alias("cigar"), F.repeat(F.lit("CG"), F.lit(64)).alias("sequence"), F.concat(F.lit("C+m?"), F.repeat(F.lit(",0"), F.lit(64)), F.lit(";")).alias("mm"), calls.alias("ml"), F.when(v % 3 > 0, (v % 3).cast("int")).alias("hp"),
    )
    folder = tables.scratch(spark)
    write_reads(rows, folder, [("chr1", 3_000_000), ("chrX", 6_000_000), ("chrY", 1000)])
    return f"{folder}/*.bam"


def _islands_of_reads(spark):
    each = spark.range(50).where("id <> 7").select("id", F.explode(F.array(F.lit("chr1"), F.lit("chrX"))).alias("chrom"))
    start = F.col("id") * 40_000 + 20 + F.when(F.col("chrom") == "chrX", 3_000_000).otherwise(0)
    return each.select("chrom", start.alias("start"), (start + F.col("id") * 3 % 80 + 1).alias("end"), F.concat(F.lit("i"), F.col("id").cast("string")).alias("name"))


def alignment_reads(spark, d):
    """What the alignment files hold, read by read: places without clips and insertions, calls on both strands, flags and haplotypes."""
    got = cli.bam(spark, _alignments(spark, d))
    total = lambda f: F.aggregate("calls", F.lit(0).cast("long"), lambda a, c: a + f(c))
    return got.select("sample", "read_id", "chrom", "ref_start", "ref_end", "is_unmapped", "is_secondary", "is_duplicate", "hp", F.size("calls").cast("long").alias("n"), total(lambda c: c["rpos"]).alias("places"), total(lambda c: c["rpos"] % 97 * c["prob"]).alias("mixed"))


def alignment_regions(spark, d):
    """Reads of some regions, by the index's bins, of the first three files by name."""
    got = cli.bam(spark, _alignments(spark, d), 3, region=regions_text([("chr1", 400_000, 400_050), ("chrX", 4_000_000, 4_480_010)]))
    return got.select("sample", "read_id", "chrom", "ref_start")


def contig_counts(spark, d):
    """Mapped reads of each contig, by the indexes alone, and the sex that they tell."""
    contigs = cli.bam(spark, _alignments(spark, d), table="contigs")
    return contigs.join(xci.sex_of(contigs).select("sample", "x_reads", "sex"), "sample")


def alignment_counts(spark, d):
    """From alignment files to counts: the chunks of the islands alone are read."""
    islands = _islands_of_reads(spark).withColumn("island_id", tables.island_id(F.col("chrom"), F.col("start"), F.col("end"))).withColumn("island_name", F.col("name")).withColumn("island_cpgNum", F.lit(1).cast("long"))
    region = regions_text((r.chrom, r.start, r.end) for r in islands.toLocalIterator())
    made = runs.count_reads(cli.bam(spark, _alignments(spark, d), region=region), islands)
    return made.select("sample", "island_id", "haplotype", "n_reads", "n_cpg_total", "n_cpg_meth", "frac_meth")


def per_read_files(spark, d):
    """The per-read table of the inactivation run on alignment files, written and read again."""
    got = runs.xci_run(cli.bam(spark, _alignments(spark, d), region="chrX"), _islands_of_reads(spark).where("chrom = 'chrX'"), min_cpg=5)
    path = tables.scratch(spark)
    tables.write_tsv(got["per_read"], path)
    back = spark.read.csv(path, sep="\t", header=True)
    return back.select("sample", "read_id", *[F.col(c).cast("long").alias(c) for c in ("haplotype", "island_start", "n_cpg", "n_cpg_meth", "n_cpg_unmeth")], F.col("meth_fraction").cast("double").alias("meth_fraction"), "classification")


def read_flags(spark, d):
    """Reads left by the cohort run, which keeps duplicates, and by the inactivation run, which drops them."""
    flags = {"is_unmapped": 11, "is_secondary": 7, "is_supplementary": 5, "is_duplicate": 3}
    reads = _t(spark, d, "orders").select("o_orderkey", *[(F.col("o_orderkey") % m == 0).alias(f) for f, m in flags.items()])
    kept = [xci.usable_reads(reads, drop_duplicates=drop).select(F.lit(drop).alias("dropped"), "o_orderkey") for drop in (False, True)]
    return kept[0].union(kept[1]).groupBy("dropped").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


def without_sex_chromosomes(spark, d):
    return counts.without_chromosomes(_placed(_counts(spark, d))).groupBy("chrom").agg(F.count("*").alias("n"), F.sum("n_reads").alias("reads"))


def merged_counts(spark, d):
    table = _counts(spark, d)
    return counts.merge_counts([table.where(F.col("haplotype") == h) for h in ("A", "N", "R")])


def haplotype_labels(spark, d):
    hp = F.when(F.col("l_linenumber") < 6, F.col("l_linenumber"))
    return _t(spark, d, "lineitem").groupBy(counts.haplotype_label(hp).alias("haplotype")).agg(F.count("*").alias("n"))


def sides_of_named_loci(spark, d):
    named = _placed(_renamed(spark, d)).where("island_name IS NOT NULL")
    return views.haplotypes_side_by_side(named, ("sample", "island_id", "island_name")).select("sample", "island_id", "island_name", r8("hap1"), r8("hap2"), r8("delta"))


WIDE = [f"Brand#{k}" for k in (1, 2, 3, 24, 25)]


def wide_fractions(spark, d):
    made = views.wide(_deep(spark, d).where("haplotype = 'all'"), "sample", "island_id", "frac_meth", WIDE)
    return made.select("sample", *[rounded(F.col(f"`{c}`"), 8).alias(c) for c in WIDE])


def deep_at_sites(spark, d):
    """The depth filter with its condition on the sites of a locus."""
    return counts.depth_filter(_placed(_counts(spark, d)), min_cpg=12).select(*KEY, "n_reads", "island_cpgNum")


def track_rows(spark, d):
    """Islands joined to what reads tell of them, with the pseudoautosomal ones: the rows of a browser track and their order."""
    told = _islands(spark, d)
    every = _t(spark, d, "part").where("p_partkey <= 14").select((F.col("p_partkey") - 1).cast("string").alias("island_id"), F.lit("chrX").alias("island_chrom"), ((F.col("p_partkey") - 1) * 1000).alias("island_start"), ((F.col("p_partkey") - 1) * 1000 + 300).alias("island_end"))
    par = _t(spark, d, "part").where("p_partkey <= 3").select(F.lit("chrX").alias("chrom"), (F.col("p_partkey") * 1000).alias("start"), (F.col("p_partkey") * 1000 + 7).alias("end"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("name"))
    return xci.bed9(xci.island_status(every.join(told, list(xci.ISLAND), "left"), **KEPT), par)


def xci_summary_numbers(spark, d):
    """The numbers of a sample's summary, as rows."""
    contigs = _t(spark, d, "events").select(F.lit("s").alias("sample"), F.when(F.col("event_type") == "click", "chrY").otherwise("chrX").alias("contig"), (F.col("user_id") % 3).alias("mapped"), (F.col("event_id") % 20 == 0).alias("few"))
    contigs = contigs.where("contig = 'chrX' OR few")
    one = lambda df: df.withColumn("sample", F.lit("s"))
    got = {"islands": _islands(spark, d).select("island_id"), "per_read": one(_reads(spark, d)), "per_island": one(_islands(spark, d)), "hemi": one(_hemi(spark, d))}
    made = runs.xci_summary("s", "s.bam", contigs, got, phasing_mode="pedigree", min_reads_per_hap=5)
    return spark.createDataFrame([(k, float(v)) for k, v in made.items() if isinstance(v, int | float)], "name string, value double")


def counts_files(spark, d):
    """Counts written to files of a sample each, and read together with files that are absent or empty."""
    table = _placed(_counts(spark, d)).select(*[k.split(" ")[0] for k in tables.COUNTS.split(", ")])
    path = tables.scratch(spark)
    for part in (0, 1):
        tables.write_tsv(table.where(F.col("sample") % 2 == part), f"{path}/{part}")
    spark.createDataFrame([], "value string").write.text(f"{path}/empty")
    back = tables.read_counts(spark, [f"{path}/{p}" for p in (0, 1, "empty", "absent")])
    return back.withColumn("sample", F.col("sample").cast("long"))


def counts_by_header(spark, d):
    """Counts in files whose columns stand in three orders, one with a column more: each is read by its own header."""
    names = [k.split(" ")[0] for k in tables.COUNTS.split(", ")]
    table, path = _placed(_counts(spark, d)), tables.scratch(spark)
    orders = (names, names[::-1], [*names[5:], "more", *names[:5]])
    for part, order in enumerate(orders):
        tables.write_tsv(table.where(F.col("sample") % 3 == part).withColumn("more", F.lit("x")).select(order), f"{path}/{part}")
    back = tables.read_counts(spark, [f"{path}/{p}" for p in (*range(len(orders)), "absent")])
    return back.select(F.col("sample").cast("long").alias("sample"), *names[1:], "more")


def cached_counts(spark, d):
    """Counts made in two goes, of which the second makes only what is new, and read from their store."""
    table = _placed(_counts(spark, d)).withColumn("sample", F.col("sample").cast("string"))
    path, make = tables.scratch(spark), lambda samples: table.join(samples, "sample", "left_semi")
    every = _t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("sample"), F.lit("a").alias("mark"))
    tables.stored_counts(every.where("sample % 2 = 0"), path, {"cutoff": 0.5}, make, as_table=True)
    return tables.stored_counts(every, path, {"cutoff": 0.5}, make, as_table=True)


def stored_counts(spark, d):
    """Counts made in three goes and read from their store: of the last, one sample has a new mark, one has no counts, the others stay as they were made."""
    table = _placed(_counts(spark, d)).withColumn("sample", F.col("sample").cast("string"))
    path, names = tables.scratch(spark), [k.split(" ")[0] for k in tables.COUNTS.split(", ")]
    # the n-th go counts n reads more, so that rows tell which made them
    make = lambda n: lambda samples: table.join(samples, "sample", "left_semi").withColumn("n_reads", F.col("n_reads") + n).select(names)
    every = _t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("sample"))
    first, empty = every.where("sample % 2 = 0").withColumn("mark", F.lit("a")), spark.createDataFrame([("none", "a")], "sample string, mark string")
    tables.stored_counts(first.union(empty), path, {"cutoff": 0.5}, make(0), as_table=True)
    tables.stored_counts(every.withColumn("mark", F.lit("a")).union(empty), path, {"cutoff": 0.5}, make(1), as_table=True)
    last = every.withColumn("mark", F.when(F.col("sample") == "3", "b").otherwise("a"))
    return tables.stored_counts(last.union(empty), path, {"cutoff": 0.5}, make(2), as_table=True)


def scored_files(spark, d):
    """The cohort run's three tables written, found beside each other, and read."""
    path, deep = tables.scratch(spark), _deep(spark, d)
    scored = _placed(_flagged_of(deep))
    tables.write_tsv(tables.in_order(scored), f"{path}/all_samples_stats")
    tables.write_tsv(cohort.locus_stats(_placed(deep), attributes=ATTRIBUTES), f"{path}/cohort_locus_stats")
    tables.write_tsv(cohort.sorted_outliers(scored), f"{path}/outliers")
    rows, stats, outliers = tables.read_scored(spark, f"{path}/all_samples_stats")
    # one pass over each file: all rows, and of the scored ones those with the flag
    n = lambda name, some: F.struct(F.lit(name).alias("name"), F.count(F.when(some, 1)).alias("n"), F.count(F.when(some & F.col("island_name").isNull(), 1)).alias("nameless"))
    told = [t.groupBy().agg(F.array(*[n(name, some) for name, some in parts.items()]).alias("told")) for t, parts in ((rows, {"scored": F.lit(True), "flagged": F.col("outlier")}), (stats, {"stats": F.lit(True)}), (outliers, {"outliers": F.lit(True)}))]
    return told[0].union(told[1]).union(told[2]).select(F.inline("told"))


def island_files(spark, d):
    """Islands written as a table with a header and as bare rows, and read by the two readers."""
    path = tables.scratch(spark)
    loci = _placed(_counts(spark, d)).select("chrom", "island_start", "island_end", "island_cpgNum", "island_name").distinct()
    loci.toDF("Chrom", "chromStart", "CHROMEND", "cpgNum", "name").write.csv(f"{path}/tsv", sep="\t", header=True)
    loci.select(F.concat_ws("\t", "chrom", F.col("island_start").cast("string"), F.col("island_end").cast("string"), F.coalesce("island_name", F.lit(" ")))).write.text(f"{path}/bed")
    one = tables.read_island_tsv(spark, f"{path}/tsv").select(F.lit("tsv").alias("kind"), "island_id", "island_name", "island_cpgNum")
    two = tables.read_island_bed(spark, f"{path}/bed", None).select(F.lit("bed").alias("kind"), tables.island_id(F.col("chrom"), F.col("start"), F.col("end")).alias("island_id"), F.col("name").alias("island_name"), F.lit(None).cast("long").alias("island_cpgNum"))
    return one.union(two)


def exclusion_file(spark, d):
    """An exclusion file to edit, written and read: whole lines, and the names that it excludes."""
    path, flags = tables.scratch(spark), _qc(spark, d)
    tables.write_exclude_list(flags, path, source="counts")
    lines = spark.read.text(path).where("value NOT RLIKE '^# (Samples to|Suggested samples)'").select(F.lit("line").alias("kind"), "value")
    return lines.union(tables.read_exclude_list(spark, path).select(F.lit("name"), "sample"))


def _percent(x: str) -> str:
    return f"CAST(CAST(round_even({x} * 100, 0) AS BIGINT) AS VARCHAR) || '%'"


def _rgb(i: int) -> str:
    to = f"CASE WHEN delta_meth >= 0 THEN {xci.GREY[i]} + t * ({xci.BLUE[i] - xci.GREY[i]}) ELSE {xci.GREY[i]} + t * ({xci.RED[i] - xci.GREY[i]}) END"
    return f"CAST(CAST(floor({to} + 1e-9) AS BIGINT) AS VARCHAR)"


def status_sql(islands: str) -> str:
    """The track's columns for a table of islands."""
    clear = {h: f"coalesce(n_meth_{h} + n_unmeth_{h}, 0)" for h in ("hap1", "hap2")}
    return f"""SELECT *, CASE status WHEN 'low_cov' THEN 'low_cov(h1=' || {clear["hap1"]} || ',h2=' || {clear["hap2"]} || ')' WHEN 'unmethylated' THEN 'unmethylated(comb=' || {_percent("meth_frac_combined")} || ')'
 WHEN 'methylated' THEN 'methylated(comb=' || {_percent("meth_frac_combined")} || ')' WHEN 'no_data' THEN 'no_data' ELSE 'd=' || CASE WHEN delta_meth < 0 THEN '-' ELSE '+' END || printf('%.2f', floor(abs(delta_meth) * 100 + 0.5e0) / 100)
  || '(h1=' || {_percent("meth_frac_hap1")} || ',h2=' || {_percent("meth_frac_hap2")} || ')' END AS label, CASE WHEN status = 'delta' THEN least(CAST(floor(abs(delta_meth) * 1000 + 1e-9) AS BIGINT), 1000) ELSE 0 END AS score,
 CASE status WHEN 'no_data' THEN '200,200,200' WHEN 'low_cov' THEN '170,170,170' WHEN 'unmethylated' THEN '140,190,230' WHEN 'methylated' THEN '230,160,100' ELSE concat_ws(',', {_rgb(0)}, {_rgb(1)}, {_rgb(2)}) END AS rgb
 FROM (SELECT *, CASE WHEN meth_frac_combined IS NULL THEN 'no_data' WHEN {clear["hap1"]} < 5 OR {clear["hap2"]} < 5 THEN 'low_cov' WHEN meth_frac_combined < 0.3 THEN 'unmethylated' WHEN meth_frac_combined > 0.7 THEN 'methylated' ELSE 'delta' END AS status,
  least(abs(delta_meth) / 0.5e0, 1e0) AS t FROM {islands})"""


def bed_sql(chrom: str, start: str, end: str, name: str, score: str, rgb: str) -> str:
    text = lambda x: f"CAST({x} AS VARCHAR)"
    return f"concat_ws(chr(9), {chrom}, {text(start)}, {text(end)}, {name}, {text(score)}, '.', {text(start)}, {text(end)}, {rgb})"


HEMI = f"{_island_sql()}, hemi AS (SELECT * FROM islands WHERE n_meth_hap1 + n_unmeth_hap1 >= 5 AND n_meth_hap2 + n_unmeth_hap2 >= 5 AND meth_frac_combined BETWEEN 0.3 AND 0.7), pct AS (SELECT * FROM (SELECT unnest(['hap1', 'combined', 'hap2', 'combined']) AS series, unnest([meth_frac_hap1, meth_frac_hap1, meth_frac_hap2, meth_frac_hap2]) * 100 AS pct FROM hemi) WHERE pct IS NOT NULL)"
QC = f"{METRICS}, qc AS (SELECT *, fe OR fc OR fm AS qc_outlier, concat_ws(' ', CASE WHEN fe THEN 'embedding_outlier' END, CASE WHEN fc THEN 'low_coverage' END, CASE WHEN fm THEN 'atypical_methylation' END) AS qc_reasons FROM (SELECT *, sample % 7 / 2e0 AS mahal_dist, sample % 7 / 2e0 > 2 AS fe, coalesce(coverage_frac < 0.99, false) AS fc, coalesce(mean_meth < 0.45 OR mean_meth > 0.6, false) AS fm FROM metrics))"
PLACED_STATS = f"{STATS}, ps AS {_place('stats')}"
_whole = lambda x: f"CAST(round({x} * 1e4) AS BIGINT)"
_mean = lambda x: f"CAST(sum({_whole(x)}) AS DOUBLE) / CAST(count({_whole(x)}) AS DOUBLE)"


def _em(rounds: int) -> str:
    """The mixture fit, round by round: each is one row, and stays as it is once the mean log-likelihood stands still."""
    density = lambda k: f"(w{k} * exp(-0.5e0 * ((x - m{k}) / sqrt(v{k})) * ((x - m{k}) / sqrt(v{k}))) / (sqrt(v{k}) * sqrt(2e0 * pi())))"
    sums = "sum(r) AS n0, sum(r * x) AS a0, sum(r * x * x) AS b0, sum(1 - r) AS n1, sum((1 - r) * x) AS a1, sum((1 - r) * x * x) AS b1, avg(ln(greatest(d, 1e-300))) AS l"
    steps = ["v AS (SELECT p_size * 2e0 AS x FROM part)", "e0 AS (SELECT 0.5e0 AS w0, 0.5e0 AS w1, 25e0 AS m0, 75e0 AS m1, greatest(var_pop(x), 1e-6) AS v0, greatest(var_pop(x), 1e-6) AS v1, CAST(NULL AS DOUBLE) AS l, false AS done FROM v)"]
    for i in range(rounds):
        told = f"SELECT x, d0 + d1 AS d, coalesce(d0 / nullif(d0 + d1, 0), CASE WHEN abs(x - m0) < abs(x - m1) THEN 1e0 ELSE 0e0 END) AS r FROM (SELECT *, {density(0)} AS d0, {density(1)} AS d1 FROM v, e{i})"
        new = ", ".join(f"CASE WHEN done THEN e.w{k} ELSE s.n{k} / (SELECT count(*) FROM v) END AS w{k}, CASE WHEN done THEN e.m{k} ELSE s.a{k} / greatest(s.n{k}, 1e-10) END AS m{k}, CASE WHEN done THEN e.v{k} ELSE greatest(s.b{k} / greatest(s.n{k}, 1e-10) - power(s.a{k} / greatest(s.n{k}, 1e-10), 2), 0e0) + 1e-6 END AS v{k}" for k in (0, 1))
        steps.append(f"e{i + 1} AS MATERIALIZED (SELECT {new}, s.l, done OR coalesce(abs(s.l - e.l) < 1e-3, false) AS done FROM e{i} e, (SELECT {sums} FROM ({told})) s)")
    low, high = ("CASE WHEN m0 <= m1 THEN {0}0 ELSE {0}1 END", "CASE WHEN m0 <= m1 THEN {0}1 ELSE {0}0 END")
    rows = [f"SELECT '{name}_{side}' AS name, {ROUND.format(f'sqrt({pick.format(c)})' if c == 'v' else pick.format(c))} AS value FROM e{rounds}" for side, pick in (("low", low), ("high", high)) for name, c in (("weight", "w"), ("mean", "m"), ("sd", "v"))]
    return f"WITH {', '.join(steps)} {' UNION ALL '.join(rows)}"


def _em_by(key: str, x: str, table: str, rounds: int) -> str:
    """The mixture fits of all groups, round by round, as CTEs; the last is ``fits``."""
    density = lambda k: f"(w{k} * exp(-0.5e0 * ((x - m{k}) / sqrt(v{k})) * ((x - m{k}) / sqrt(v{k}))) / (sqrt(v{k}) * sqrt(2e0 * pi())))"
    first = "greatest(sum(c * x * x) / sum(c) - power(sum(c * x) / sum(c), 2), 1e-6)"
    steps = [f"v AS (SELECT {key}, {x} AS x, count(*) AS c FROM {table} GROUP BY ALL)", f"e0 AS (SELECT {key}, CAST(sum(c) AS BIGINT) AS n, 0.5e0 AS w0, 0.5e0 AS w1, 25e0 AS m0, 75e0 AS m1, {first} AS v0, {first} AS v1, CAST(NULL AS DOUBLE) AS l, false AS done FROM v GROUP BY 1 HAVING sum(c) >= 10)"]
    for i in range(rounds):
        told = f"SELECT {key}, c, x, d0 + d1 AS d, coalesce(d0 / nullif(d0 + d1, 0), CASE WHEN abs(x - m0) < abs(x - m1) THEN 1e0 ELSE 0e0 END) AS r FROM (SELECT *, {density(0)} AS d0, {density(1)} AS d1 FROM v JOIN e{i} USING ({key}))"
        sums = f"SELECT {key}, sum(c * r) AS n0, sum(c * r * x) AS a0, sum(c * r * x * x) AS b0, sum(c * (1 - r)) AS n1, sum(c * (1 - r) * x) AS a1, sum(c * (1 - r) * x * x) AS b1, sum(c * ln(greatest(d, 1e-300))) / sum(c) AS l FROM ({told}) GROUP BY 1"
        new = ", ".join(f"CASE WHEN done THEN e.w{k} ELSE s.n{k} / e.n END AS w{k}, CASE WHEN done THEN e.m{k} ELSE s.a{k} / greatest(s.n{k}, 1e-10) END AS m{k}, CASE WHEN done THEN e.v{k} ELSE greatest(s.b{k} / greatest(s.n{k}, 1e-10) - power(s.a{k} / greatest(s.n{k}, 1e-10), 2), 0e0) + 1e-6 END AS v{k}" for k in (0, 1))
        steps.append(f"e{i + 1} AS MATERIALIZED (SELECT {key}, e.n, {new}, s.l, done OR coalesce(abs(s.l - e.l) < 1e-3, false) AS done FROM e{i} e JOIN ({sums}) s USING ({key}))")
    pick = lambda c, side: f"CASE WHEN (m0 <= m1) = {'true' if side == 'low' else 'false'} THEN {c}0 ELSE {c}1 END"
    columns = ", ".join(f"{'sqrt(' + pick('v', s) + ')' if c == 'sd' else pick(c[0], s)} AS {c}_{s}" for s in ("low", "high") for c in ("weight", "mean", "sd"))
    return ", ".join([*steps, f"fits AS (SELECT {key}, n, {columns} FROM e{rounds})"])


#: The reads of the alignment files: r, and their calls with a place: c. A call's base is the k-th C, from the other end on the reverse strand.
ALIGNMENTS = """r AS (SELECT vec_id AS v, 's' || vec_id % 4 AS sample, 'r' || vec_id AS read_id, CASE WHEN vec_id % 2 = 0 THEN 'chr1' ELSE 'chrX' END AS chrom, vec_id % 50 * 40000 + vec_id % 7 + vec_id % 2 * 3000000 AS pos,
  vec_id % 11 = 0 AS is_unmapped, vec_id % 7 = 0 AS is_secondary, vec_id % 5 = 0 AS is_duplicate, vec_id % 3 AS hp, embedding FROM embeddings),
q AS (SELECT * EXCLUDE (embedding), CASE WHEN v % 3 = 0 THEN 127 - 2 * k ELSE 2 * k END AS q, CAST(greatest(0, least(255, floor((CAST(embedding[k + 1] AS DOUBLE) + 1) * 120))) AS BIGINT) AS prob FROM r, range(64) g(k)),
c AS (SELECT *, CASE WHEN q < 64 THEN pos + q - 4 ELSE pos + q - 6 END AS rpos FROM q WHERE q >= 4 AND (q < 64 OR q >= 66)),
isles AS (SELECT chrom, x + i * 40000 + 20 AS a, x + i * 40000 + 20 + i * 3 % 80 + 1 AS b FROM range(50) g(i), (VALUES ('chr1', 0), ('chrX', 3000000)) n(chrom, x) WHERE i <> 7)"""
SPANNING = "spanning AS (SELECT r.*, a, b FROM r JOIN isles USING (chrom) WHERE pos <= a AND pos + 122 >= b AND NOT is_unmapped AND NOT is_secondary)"

BRANDS = _em_by("p_brand", "p_size * 2e0", "part", 40)

ORACLE = {
    "manhattan_positions": f"WITH {PLACED}, hit AS (SELECT * FROM placed WHERE outlier AND (haplotype = 'all' OR NOT EXISTS (SELECT 1 FROM placed WHERE outlier AND haplotype = 'all'))) SELECT island_id, chrom, ord, x_pos, n_outliers, mean_z, floor(greatest(4e0, least(18e0, 4 + 3 * ln(1 + n_outliers))) * 1e4 + 0.5e0) / 1e4 AS size FROM (SELECT island_id, min(chrom) AS chrom, min(ord) AS ord, min({X_POS}) AS x_pos, count(DISTINCT sample) AS n_outliers, floor({_mean('z_score')} + 0.5e0) / 1e4 AS mean_z FROM hit JOIN c USING (chrom) GROUP BY island_id)",
    "manhattan_by_haplotype": f"WITH {PLACED} SELECT {KEYS}, chrom, {X_POS} AS x_pos, z_score, ord % 2 = 1 AS odd_chrom FROM (SELECT *, row_number() OVER (PARTITION BY haplotype ORDER BY abs(z_score) DESC NULLS LAST, sample, island_id) AS rank FROM placed WHERE outlier) JOIN c USING (chrom) WHERE rank <= 20",
    "hap_delta_manhattan": f"WITH {GENOME}, told AS ({FIRST['hap_delta_by_locus']}) SELECT island_id, chrom, {X_POS} AS x_pos, mean_delta, floor(greatest(3e0, least(14e0, 3 + 14 * mean_delta)) * 1e4 + 0.5e0) / 1e4 AS size FROM {_place('told')} JOIN c USING (chrom)",
    "sample_manhattan_points": f"WITH {PLACED}, points AS (SELECT *, {X_POS} AS x_pos, row_number() OVER (PARTITION BY sample, chrom ORDER BY abs(z_score) DESC, island_id) AS rank, coalesce(island_name, island_id) AS name FROM placed JOIN c USING (chrom) WHERE haplotype = 'all' AND p_adj IS NOT NULL) SELECT {KEYS}, chrom, x_pos, z_score, floor(sign(z_score) * -log10(greatest(p_adj, 1e-300)) * 1e6 + 0.5e0) / 1e6 AS signed_logp, floor(CASE WHEN abs(z_score) - 2e0 >= 0 THEN greatest(6e0, least(14e0, 6 + 1.5e0 * (abs(z_score) - 2e0))) ELSE 4.5e0 END * 1e4 + 0.5e0) / 1e4 AS size, CASE WHEN abs(z_score) - 2e0 >= 0 AND rank <= 3 THEN CASE WHEN length(name) > 18 THEN substring(name, 1, 17) || '…' ELSE name END END AS label FROM points",
    "smallest_p": f"WITH {PVALUES} SELECT {KEYS}, z_score, {s8('p_value')}, rank FROM (SELECT *, row_number() OVER (PARTITION BY haplotype ORDER BY p_value, abs(z_score) DESC, sample, island_id) AS rank FROM flagged WHERE p_value IS NOT NULL) WHERE rank <= 10",
    "locus_distributions": f"WITH {PLACED_STATS}, v AS (SELECT unnest(['island_size', 'island_cpgNum', 'cohort_mean']) AS panel, unnest([CAST(island_end - island_start AS DOUBLE), CAST(\"island_cpgNum\" AS DOUBLE), cohort_mean]) AS x FROM ps WHERE haplotype = 'all'), r(panel, low, high, n) AS (VALUES ('island_size', 300e0, 330e0, 10), ('island_cpgNum', 0e0, 26e0, 13), ('cohort_mean', 0e0, 1e0, 50)) SELECT panel, CAST(least(floor((x - low) / ((high - low) / n)) + 1, n) AS BIGINT) AS bin, count(*) AS n FROM v JOIN r USING (panel) WHERE x BETWEEN low AND high GROUP BY 1, 2",
    "locus_distributions_whole": f"WITH {PLACED_STATS}, v AS (SELECT unnest(['island_size', 'island_cpgNum', 'cohort_mean']) AS panel, unnest([50, 40, 50]) AS bins, unnest([CAST(island_end - island_start AS DOUBLE), CAST(\"island_cpgNum\" AS DOUBLE), cohort_mean]) AS x FROM ps WHERE haplotype = 'all'), e AS (SELECT panel, min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / min(bins) AS w, min(bins) AS most FROM v GROUP BY panel), b AS (SELECT panel, lo, hi, w, CAST(CASE WHEN w > 0 THEN least(floor((x - lo) / w) + 1, most) ELSE 1 END AS BIGINT) AS bin FROM v JOIN e USING (panel) WHERE x IS NOT NULL) SELECT panel, bin, count(*) AS n, {ROUND.format('(lo + (bin - 1) * w)')} AS low, {ROUND.format('(CASE WHEN w > 0 THEN lo + bin * w ELSE hi END)')} AS high FROM b GROUP BY panel, bin, lo, hi, w",
    "price_histogram": "WITH e AS (SELECT l_returnflag, min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 20 AS w FROM lineitem GROUP BY 1) SELECT l_returnflag, bin, count(*) AS n, floor((lo + (bin - 1) * w) * 1e4 + 0.5e0) / 1e4 AS low, floor((lo + bin * w) * 1e4 + 0.5e0) / 1e4 AS high FROM (SELECT l_returnflag, lo, w, CAST(least(floor((l_extendedprice - lo) / w) + 1, 20) AS BIGINT) AS bin FROM lineitem JOIN e USING (l_returnflag)) GROUP BY l_returnflag, bin, lo, w",
    "largest_orders": "SELECT o_orderpriority, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rank FROM orders) WHERE rank <= 2000",
    "price_quantiles": "SELECT s_nationkey, count(l_extendedprice) AS n, " + ", ".join(f"floor(quantile_cont(l_extendedprice, {q}) * 1e4 + 0.5e0) / 1e4 AS {n}" for q, n in ((0.01, "q01"), (0.5, "q50"), (0.999, "q999"))) + " FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1",
    "stats_headline": f"WITH {STATS} SELECT count(DISTINCT island_id) AS n_loci, CAST(floor(quantile_cont(cohort_n_samples, 0.5)) AS BIGINT) AS median_samples FROM stats",
    "locus_boxes": f"WITH {STATS} SELECT island_id, haplotype, count(frac_meth) AS n, " + ", ".join(f"{ROUND.format(f'quantile_cont(frac_meth, {q})')} AS {n}" for n, q in (("low", 0), ("q25", 0.25), ("median", 0.5), ("q75", 0.75), ("high", 1))) + " FROM deep GROUP BY island_id, haplotype",
    "first_per_locus": f"WITH {COUNTS} SELECT DISTINCT island_id, island_name, chrom, island_start, island_end FROM {_place('counts')}",
    "loci_in_order": f"WITH {COUNTS}, {GENOME} SELECT DISTINCT island_id, chrom, ord FROM {_place('counts')} JOIN c USING (chrom)",
    "qc_records": f"WITH {QC} SELECT m.sample, m.mean_meth AS x, m.mean_reads AS y, coalesce(q.mean_meth, 0) AS mean_meth, coalesce(q.coverage_frac, 0) AS coverage_frac, coalesce(q.mean_reads, 0) AS mean_reads, coalesce(q.mahal_dist, 0) AS mahal_dist, coalesce(q.qc_reasons, '') AS qc_reasons, coalesce(q.qc_outlier, false) AS auto_exclude FROM metrics m LEFT JOIN (SELECT * FROM qc WHERE sample % 5 <> 0) q ON q.sample = m.sample",
    "qc_bars": f"WITH {QC} SELECT unnest(['coverage_frac', 'mean_meth', 'mean_reads']) AS panel, sample, unnest([coverage_frac, mean_meth, mean_reads]) AS value, qc_outlier AS outlier FROM qc",
    "embedding_samples": f"WITH {PVALUES}, told AS (SELECT sample, floor({_mean('frac_meth')} * 1e2 + 0.5e0) / 1e2 / 1e4 AS mean_meth, count(DISTINCT island_id) AS n_loci, count(DISTINCT island_id) FILTER (outlier) AS n_outliers FROM flagged WHERE sample % 3 <> 0 GROUP BY sample) SELECT s_suppkey AS sample, s_acctbal AS pc1, mean_meth, n_loci, coalesce(n_outliers, 0) AS n_outliers FROM supplier LEFT JOIN told ON sample = s_suppkey",
    "spread_limits": f"WITH {PVALUES} SELECT floor(greatest(3e0 * stddev_pop(z_score), 2.5e0) * 1e6 + 0.5e0) / 1e6 AS cmax FROM flagged",
    "xci_scatter": f"WITH {HEMI} SELECT island_id, {ROUND.format('meth_frac_hap1 * 100')} AS hap1_pct, {ROUND.format('meth_frac_hap2 * 100')} AS hap2_pct, {ROUND.format('abs(meth_frac_hap1 - meth_frac_hap2)')} AS abs_delta FROM hemi",
    "haplotype_percentages": f"WITH {HEMI} SELECT series, {s8('pct')} FROM pct",
    "xci_distribution": f"WITH {HEMI}, m AS (SELECT series, count(*) AS n, stddev_samp(pct) * power(count(*), -1e0 / 5) AS w FROM pct GROUP BY series) SELECT series, CAST(i AS INTEGER) AS i, {ROUND.format('sum(exp(-0.5e0 * power((i * 2e0 - pct) / w, 2))) / (min(n) * min(w) * sqrt(2 * pi()))')} AS density FROM pct JOIN m USING (series), range(51) g(i) WHERE n > 1 AND w > 0 GROUP BY series, i",
    "xci_histogram": f"WITH {HEMI} SELECT series, CAST(least(floor(pct / 5e0) + 1, 20) AS BIGINT) AS bin, count(*) AS n FROM pct WHERE pct BETWEEN 0 AND 100 GROUP BY 1, 2",
    "normal_overlay": " UNION ALL ".join(f"SELECT x, '{s}' AS component, {ROUND.format(f'200e0 * {w} * exp(-0.5e0 * ((x - {m}) / {sd}) * ((x - {m}) / {sd})) / ({sd} * sqrt(2e0 * pi()))')} AS density FROM (SELECT DISTINCT CAST(p_size AS DOUBLE) AS x FROM part)" for s, w, m, sd in (("low", "0.4e0", "25e0", "10e0"), ("high", "0.6e0", "75e0", "12.5e0"))),
    "alignment_reads": f"WITH {ALIGNMENTS} SELECT sample, read_id, chrom, pos AS ref_start, pos + 122 AS ref_end, is_unmapped, is_secondary, is_duplicate, CASE WHEN hp > 0 THEN CAST(hp AS INTEGER) END AS hp, coalesce(n, 0) AS n, CAST(coalesce(places, 0) AS BIGINT) AS places, CAST(coalesce(mixed, 0) AS BIGINT) AS mixed FROM r LEFT JOIN (SELECT v, count(*) AS n, sum(rpos) AS places, sum(rpos % 97 * prob) AS mixed FROM c WHERE NOT is_unmapped GROUP BY v) USING (v)",
    "alignment_regions": f"WITH {ALIGNMENTS} SELECT sample, read_id, chrom, pos AS ref_start FROM r WHERE sample <> 's3' AND ((chrom = 'chr1' AND pos < 400050 AND pos + 122 > 400000) OR (chrom = 'chrX' AND pos < 4480010 AND pos + 122 > 4000000))",
    "contig_counts": f"WITH {ALIGNMENTS}, m AS (SELECT s.sample, contig, count(read_id) FILTER (NOT is_unmapped) AS mapped FROM (SELECT DISTINCT sample FROM r) s CROSS JOIN (VALUES ('chr1'), ('chrX'), ('chrY')) n(contig) LEFT JOIN r ON r.sample = s.sample AND r.chrom = contig GROUP BY 1, 2) SELECT sample, contig, mapped, CAST(sum(CASE WHEN contig = 'chrX' THEN mapped ELSE 0 END) OVER (PARTITION BY sample) AS BIGINT) AS x_reads, CASE WHEN sum(CASE WHEN contig = 'chrX' THEN mapped ELSE 0 END) OVER (PARTITION BY sample) > 0 THEN 'F' ELSE 'unknown' END AS sex FROM (SELECT s.sample, contig, mapped FROM m s)",
    "alignment_counts": f"WITH {ALIGNMENTS}, {SPANNING}, told AS (SELECT s.sample, s.chrom || ':' || a || '-' || b AS island_id, CASE s.hp WHEN 1 THEN 'hap1' WHEN 2 THEN 'hap2' ELSE 'unphased' END AS haplotype, s.v, count(*) AS n, count(*) FILTER (prob >= 127) AS m FROM spanning s JOIN c ON c.v = s.v AND rpos >= a AND rpos < b GROUP BY ALL) SELECT sample, island_id, CASE WHEN grouping(haplotype) = 1 THEN 'all' ELSE haplotype END AS haplotype, count(*) AS n_reads, CAST(sum(n) AS BIGINT) AS n_cpg_total, CAST(sum(m) AS BIGINT) AS n_cpg_meth, floor(sum(m) * 1e4 / sum(n) + 0.5e0) / 1e4 AS frac_meth FROM told GROUP BY GROUPING SETS ((sample, island_id, haplotype), (sample, island_id))",
    "per_read_files": f"WITH {ALIGNMENTS}, {SPANNING}, told AS (SELECT s.sample, s.read_id, s.hp AS haplotype, a AS island_start, count(*) AS n_cpg, count(*) FILTER (prob >= 128) AS n_cpg_meth FROM spanning s JOIN c ON c.v = s.v AND rpos >= a AND rpos < b WHERE s.chrom = 'chrX' AND NOT s.is_duplicate AND NOT (b > 60001 AND a < 2699520) GROUP BY ALL) SELECT *, n_cpg - n_cpg_meth AS n_cpg_unmeth, floor(n_cpg_meth * 1e4 / n_cpg + 0.5e0) / 1e4 AS meth_fraction, CASE WHEN n_cpg_meth / n_cpg >= 0.75 THEN 'methylated' WHEN n_cpg_meth / n_cpg <= 0.25 THEN 'unmethylated' ELSE 'partial' END AS classification FROM told WHERE n_cpg >= 5",
    "gmm_by_brand": f"WITH {BRANDS} SELECT p_brand, n, " + ", ".join(f"floor({c}_{s} * 1e6 + 0.5e0) / 1e6 AS {c}_{s}" for s in ("low", "high") for c in ("weight", "mean", "sd")) + " FROM fits",
    "mixture_overlays": f"WITH {BRANDS}, g AS (SELECT *, i * 5e0 AS x FROM fits, range(21) g(i)), " + "c AS (" + " UNION ALL ".join(f"SELECT p_brand, n, i, '{s}' AS component, weight_{s} * exp(-0.5e0 * ((x - mean_{s}) / sd_{s}) * ((x - mean_{s}) / sd_{s})) / (sd_{s} * sqrt(2e0 * pi())) AS y FROM g" for s in ("low", "high")) + ") SELECT p_brand, plot, component, CAST(i AS INTEGER) AS i, floor(y * CASE plot WHEN 'histogram' THEN n * 2e0 ELSE 1e0 END * 1e6 + 0.5e0) / 1e6 AS y FROM c, (VALUES ('distribution'), ('histogram')) p(plot)",
    "kde_by_brand": "WITH v AS (SELECT p_brand, p_size * 2e0 AS v FROM part), m AS (SELECT p_brand, count(*) AS n, stddev_samp(v) * power(count(*), -1e0 / 5) AS w FROM v GROUP BY 1) SELECT p_brand, CAST(i AS INTEGER) AS i, floor(sum(exp(-0.5e0 * power((i - v) / w, 2))) / (min(n) * min(w) * sqrt(2 * pi())) * 1e8 + 0.5e0) / 1e8 AS density FROM v JOIN m USING (p_brand), range(101) g(i) WHERE n > 1 AND w > 0 GROUP BY 1, i",
    "qc_run": f"SELECT sample, coverage_frac, mean_meth, far AS mahal_dist, fe AS flag_embedding, flag_coverage, flag_meth, fe OR qc_outlier AS qc_outlier, concat_ws(' ', CASE WHEN fe THEN 'embedding_outlier' END, nullif(qc_reasons, '')) AS qc_reasons FROM (SELECT *, coalesce(far > 2.0, false) AS fe FROM ({FIRST['qc_flags']}) LEFT JOIN (SELECT sample, floor(mahal_dist * 1e3 + 0.5e0) / 1e3 AS far FROM ({FIRST['pca_mahalanobis']})) USING (sample))",
    "axis_shares": f"WITH {COMPONENTS}, t AS (SELECT count(*) AS total FROM (SELECT *, stddev_pop(v) OVER (PARTITION BY island_id) AS sd FROM full_grid) WHERE sd > 0) SELECT 'pc1' AS axis, floor(e / total * 1e8 + 0.5e0) / 1e8 AS share FROM v1, t UNION ALL SELECT 'pc2', floor(e / total * 1e8 + 0.5e0) / 1e8 FROM v2, t",
    "incremental_cohort": f"WITH {STATS} SELECT island_id, haplotype, cohort_n_samples, {s8(*STAT_COLS)} FROM stats",
    "outliers_in_order": f"WITH {PVALUES} SELECT {KEYS}, z_score, row_number() OVER (ORDER BY island_id, haplotype, abs(z_score) DESC NULLS LAST, sample) - 1 AS rank FROM flagged WHERE outlier",
    "loci_on_genome": f"WITH {COUNTS}, {GENOME} SELECT *, row_number() OVER (ORDER BY ord, island_start, island_id) - 1 AS rank FROM (SELECT DISTINCT island_id, ord, island_start FROM {_place('counts')} JOIN c USING (chrom))",
    "read_flags": "SELECT dropped, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders, (VALUES (false), (true)) v(dropped) WHERE o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 AND NOT (dropped AND o_orderkey % 3 = 0) GROUP BY dropped",
    "without_sex_chromosomes": f"WITH {COUNTS} SELECT chrom, count(*) AS n, CAST(sum(n_reads) AS BIGINT) AS reads FROM {_place('counts')} WHERE chrom NOT IN ('chrX', 'chrY') GROUP BY chrom",
    "merged_counts": f"WITH {COUNTS} SELECT * FROM counts WHERE haplotype <> 'all'",
    "haplotype_labels": "SELECT CASE l_linenumber WHEN 1 THEN 'hap1' WHEN 2 THEN 'hap2' ELSE 'unphased' END AS haplotype, count(*) AS n FROM lineitem GROUP BY 1",
    "sides_of_named_loci": f"WITH {RENAMED} SELECT sample, island_id, island_name, {s8('hap1', 'hap2', 'delta')} FROM {_place('sides')} WHERE island_name IS NOT NULL",
    "wide_fractions": f"WITH {STATS} SELECT sample, " + ", ".join(f"""{ROUND.format(f"avg(frac_meth) FILTER (island_id = '{c}')")} AS "{c}\"""" for c in WIDE) + " FROM deep WHERE haplotype = 'all' GROUP BY sample",
    "deep_at_sites": f"WITH {STATS} SELECT {KEYS}, n_reads, \"island_cpgNum\" FROM {_place('deep')} WHERE \"island_cpgNum\" >= 12",
    "track_rows": f"WITH {_island_sql()}, every AS (SELECT e.*, i.* EXCLUDE (island_id, island_chrom, island_start, island_end) FROM (SELECT CAST(p_partkey - 1 AS VARCHAR) AS island_id, 'chrX' AS island_chrom, (p_partkey - 1) * 1000 AS island_start, (p_partkey - 1) * 1000 + 300 AS island_end FROM part WHERE p_partkey <= 14) e LEFT JOIN islands i USING (island_id, island_chrom, island_start, island_end)) SELECT island_start AS start, false AS is_par, {bed_sql('island_chrom', 'island_start', 'island_end', chr(39).join(['island_id || ', '|', ' || label']), 'score', 'rgb')} AS line FROM ({status_sql('every')}) UNION ALL SELECT p_partkey * 1000, true, {bed_sql(chr(39) + 'chrX' + chr(39), 'p_partkey * 1000', 'p_partkey * 1000 + 7', chr(39).join(['', 'P', ' || p_partkey || ', '|PAR', '']), '0', chr(39) + '128,128,128' + chr(39))} FROM part WHERE p_partkey <= 3",
    "xci_summary_numbers": f"""WITH {HEMI}, k AS (SELECT CAST(sum(user_id % 3) FILTER (event_type <> 'click') AS DOUBLE) AS x, CAST(sum(user_id % 3) FILTER (event_type = 'click' AND event_id % 20 = 0) AS DOUBLE) AS y FROM events)
 SELECT name, CAST(value AS DOUBLE) AS value FROM (SELECT unnest(['sex_check_n_chrx_sampled', 'sex_check_n_chry_sampled', 'sex_check_chry_frac']) AS name, unnest([x, y, floor(y / (x + y) * 1e3 + 0.5e0) / 1e3]) AS value FROM k
 UNION ALL SELECT 'n_islands_nonPAR', count(*) FROM islands UNION ALL SELECT 'n_reads_retained', count(*) FROM reads UNION ALL SELECT 'n_islands_sufficient_coverage', count(*) FROM islands WHERE n_meth_hap1 + n_unmeth_hap1 >= 5 AND n_meth_hap2 + n_unmeth_hap2 >= 5 UNION ALL SELECT 'n_islands_hemi_methylated', count(*) FROM hemi
 UNION ALL SELECT unnest(['meth_frac_hap1_median', 'meth_frac_hap2_median', 'meth_frac_hap1_mean', 'meth_frac_hap2_mean', 'xci_bias_hap1', 'xci_bias_hap2']), unnest([{R4.format('quantile_cont(meth_frac_hap1 * 100, 0.5)')}, {R4.format('quantile_cont(meth_frac_hap2 * 100, 0.5)')}, {R4.format(_mean('meth_frac_hap1') + ' / 100')}, {R4.format(_mean('meth_frac_hap2') + ' / 100')}, {R4.format('quantile_cont(meth_frac_hap1, 0.5)')}, {R4.format('quantile_cont(meth_frac_hap2, 0.5)')}]) FROM hemi) WHERE value IS NOT NULL""",
    "counts_files": f"WITH {COUNTS} SELECT sample, island_id, island_name, chrom, island_start, island_end, \"island_cpgNum\", haplotype, n_reads, n_cpg_total, n_cpg_meth, n_cpg_unmeth, frac_meth FROM {_place('counts')}",
    "counts_by_header": f"WITH {COUNTS} SELECT sample, island_id, island_name, chrom, island_start, island_end, \"island_cpgNum\", haplotype, n_reads, n_cpg_total, n_cpg_meth, n_cpg_unmeth, frac_meth, CASE WHEN sample % 3 = 2 THEN 'x' END AS more FROM {_place('counts')}",
    "cached_counts": f"WITH {COUNTS} SELECT CAST(sample AS VARCHAR) AS sample, island_id, island_name, chrom, island_start, island_end, \"island_cpgNum\", haplotype, n_reads, n_cpg_total, n_cpg_meth, n_cpg_unmeth, frac_meth FROM {_place('counts')}",
    "stored_counts": f"WITH {COUNTS} SELECT CAST(sample AS VARCHAR) AS sample, island_id, island_name, chrom, island_start, island_end, \"island_cpgNum\", haplotype, n_reads + CASE WHEN sample = 3 THEN 2 ELSE sample % 2 END AS n_reads, n_cpg_total, n_cpg_meth, n_cpg_unmeth, frac_meth FROM {_place('counts')}",
    "scored_files": f"WITH {PLACED}, ps AS {_place('stats')} SELECT 'scored' AS name, count(*) AS n, count(*) FILTER (island_name IS NULL) AS nameless FROM placed UNION ALL SELECT 'stats', count(*), count(*) FILTER (island_name IS NULL) FROM ps UNION ALL SELECT unnest(['outliers', 'flagged']), count(*), count(*) FILTER (island_name IS NULL) FROM placed WHERE outlier",
    "island_files": f"WITH {COUNTS}, l AS (SELECT DISTINCT chrom || ':' || island_start || '-' || island_end AS id, island_name AS name, \"island_cpgNum\" AS n FROM {_place('counts')}) SELECT 'tsv' AS kind, id AS island_id, name AS island_name, n AS \"island_cpgNum\" FROM l UNION ALL SELECT 'bed', id, coalesce(name, id), NULL FROM l",
    "exclusion_file": f"WITH {QC} SELECT 'line' AS kind, CASE WHEN qc_outlier THEN sample || '  # ' || qc_reasons ELSE '# ' || sample END AS value FROM qc UNION ALL SELECT 'name', CAST(sample AS VARCHAR) FROM qc WHERE qc_outlier UNION ALL SELECT 'line', unnest(['# Source: counts', '# Samples: ' || count(*), '# Suggested: ' || count(*) FILTER (qc_outlier)]) FROM qc UNION ALL SELECT 'line', '# (none)' FROM qc HAVING count(*) FILTER (qc_outlier) = 0",
    # twins of queries of the first module whose values or columns are told here
    "gmm_fit": _em(60),
    "json_summary": f"""WITH {COUNTS} SELECT '{{"haplotype":"' || haplotype || '","n":' || count(*) || ',"reads":' || CAST(sum(n_reads) AS BIGINT) || '}}' AS json FROM counts GROUP BY haplotype""",
    "sample_summary": f"WITH {PVALUES} SELECT sample, floor({_mean('frac_meth')} * 1e2 + 0.5e0) / 1e2 / 1e4 AS mean_meth, count(DISTINCT island_id) AS n_loci, count(DISTINCT island_id) FILTER (outlier) AS n_outliers FROM flagged GROUP BY sample",
    "igv_status_rgb": f"WITH {_island_sql()} SELECT island_id, status, label, score, rgb FROM ({status_sql('islands')})",
    "bed9_lines": f"WITH {_island_sql()} SELECT island_start AS start, {bed_sql('island_chrom', 'island_start', 'island_end', chr(39).join(['island_id || ', '|', ' || label']), 'score', 'rgb')} AS line FROM ({status_sql('islands')})",
}

ORACLE["track_in_order"] = f"SELECT line, row_number() OVER (ORDER BY start, is_par DESC, line) - 1 AS rank FROM ({ORACLE['track_rows']})"

QUERIES = {
    f.__name__: f
    for f in (
        manhattan_positions, manhattan_by_haplotype, hap_delta_manhattan, sample_manhattan_points, smallest_p, locus_distributions, locus_distributions_whole, price_histogram, largest_orders, price_quantiles, stats_headline, locus_boxes, first_per_locus, loci_in_order,
        qc_records, qc_bars, embedding_samples, spread_limits, xci_scatter, haplotype_percentages, xci_distribution, xci_histogram, normal_overlay, read_flags, without_sex_chromosomes,
        merged_counts, haplotype_labels, sides_of_named_loci, wide_fractions, deep_at_sites, track_rows, xci_summary_numbers, counts_files, counts_by_header, cached_counts, stored_counts, scored_files, island_files, exclusion_file,
        alignment_reads, alignment_regions, contig_counts, alignment_counts, per_read_files, gmm_by_brand, mixture_overlays, kde_by_brand, qc_run, axis_shares, incremental_cohort, outliers_in_order, loci_on_genome, track_in_order,
    )
}
