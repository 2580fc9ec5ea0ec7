"""Queries on star-schema tables: suppliers as samples, brands as loci, return flags as haplotypes. Each has its SQL twin where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from islet.functions.numeric import ERFC, rounded, sanitized
from islet.functions.storage import keep
from islet.operators import cohort, counts, intervals, qc, views, xci

LINE = dict(min_reads=15, min_reads_hap=8, cpg=None)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _counts(spark: SparkSession, d: str) -> DataFrame:
    """Counted once: queries go over them several times."""
    part = _t(spark, d, "part").select("p_partkey", F.col("p_brand").alias("island_id"))
    line = _t(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    reads = line.select(F.col("l_suppkey").alias("sample"), "island_id", F.col("l_returnflag").alias("haplotype"), F.col("l_quantity").alias("n_total"), F.when(F.col("l_discount") >= 0.05, F.col("l_quantity")).otherwise(0.0).alias("n_meth"))
    return keep(counts.rollup_counts(reads))


def _deep(spark, d):
    return counts.depth_filter(_counts(spark, d), **LINE)


def _stats(spark, d):
    return cohort.locus_stats(_deep(spark, d))


def _flagged(spark, d):
    return _flagged_of(_deep(spark, d))


def _flagged_of(deep):
    return cohort.add_pvalues_and_flags(cohort.score_standard(deep, keep(cohort.locus_stats(deep))))


COUNTS = """counts AS (
 SELECT *, n_cpg_total - n_cpg_meth AS n_cpg_unmeth, floor(n_cpg_meth * 1e4 / n_cpg_total + 0.5e0) / 1e4 AS frac_meth FROM (
  SELECT l_suppkey AS sample, p_brand AS island_id, CASE WHEN grouping(l_returnflag) = 1 THEN 'all' ELSE l_returnflag END AS haplotype, count(*) AS n_reads,
   CAST(sum(l_quantity) AS BIGINT) AS n_cpg_total, CAST(sum(CASE WHEN l_discount >= 0.05 THEN l_quantity ELSE 0 END) AS BIGINT) AS n_cpg_meth
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY GROUPING SETS ((l_suppkey, p_brand, l_returnflag), (l_suppkey, p_brand))) WHERE n_cpg_total > 0)"""
DEEP = COUNTS + """, deep AS (SELECT * FROM counts WHERE (haplotype = 'all' AND n_reads >= 15) OR (haplotype <> 'all' AND n_reads >= 8))"""
MOMENTS = """SELECT island_id, haplotype, count(DISTINCT sample) AS ns, count(f) AS n, CAST(sum(f) AS DOUBLE) AS s, CAST(sum(f * f) AS DOUBLE) AS q,
  quantile_cont(frac_meth, 0.25) AS q25, quantile_cont(frac_meth, 0.5) AS q50, quantile_cont(frac_meth, 0.75) AS q75, min(frac_meth) AS lo, max(frac_meth) AS hi
 FROM (SELECT *, CAST(round(frac_meth * 1e4) AS BIGINT) AS f FROM deep) GROUP BY island_id, haplotype"""
VAR = "CASE WHEN n > 1 THEN greatest((q - s * s / n) / (n - 1) / 1e8, 0e0) END"
STATS = f"""{DEEP}, stats AS (SELECT island_id, haplotype, ns AS cohort_n_samples, CASE WHEN ns >= 5 THEN s / n / 1e4 END AS cohort_mean, CASE WHEN ns >= 5 THEN sqrt({VAR}) END AS cohort_std,
  CASE WHEN ns >= 5 THEN q50 END AS cohort_median, CASE WHEN ns >= 5 THEN q25 END AS cohort_q25, CASE WHEN ns >= 5 THEN q75 END AS cohort_q75, lo AS cohort_min, hi AS cohort_max, CASE WHEN ns >= 5 THEN q75 - q25 END AS cohort_IQR FROM ({MOMENTS}))"""
SCORED = STATS + """, scored AS (SELECT d.*, cohort_n_samples, cohort_mean, cohort_std, cohort_median, cohort_q25, cohort_q75, cohort_IQR,
  floor((frac_meth - cohort_mean) / nullif(cohort_std, 0) * 1e4 + 0.5e0) / 1e4 AS z_score FROM deep d LEFT JOIN stats USING (island_id, haplotype))"""
_poly = repr(ERFC[0])
for _c in ERFC[1:]:
    _poly = f"({_c!r} + t * {_poly})"
PVALUES = SCORED + f""", pv AS (SELECT *, CASE WHEN z_score IS NOT NULL THEN least(1e0, t * exp(-x * x + {_poly})) END AS p_value FROM (SELECT *, 1e0 / (1e0 + 0.5e0 * x) AS t FROM (SELECT *, abs(z_score) / sqrt(2e0) AS x FROM scored)))
, ranked AS (SELECT *, p_value * count(p_value) OVER (PARTITION BY haplotype) / count(p_value) OVER (PARTITION BY haplotype ORDER BY p_value NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS raw FROM pv)
, fdr AS (SELECT *, CASE WHEN p_value IS NOT NULL THEN least(1e0, min(raw) OVER (PARTITION BY haplotype ORDER BY p_value DESC NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END AS p_adj FROM ranked)
, flagged AS (SELECT *, iqr_o AS "IQR_outlier", z_o AS "Z_outlier", iqr_o OR z_o AS outlier FROM (SELECT *, coalesce(frac_meth < cohort_q25 - 1.5e0 * coalesce(cohort_IQR, 0) OR frac_meth > cohort_q75 + 1.5e0 * coalesce(cohort_IQR, 0), false) AS iqr_o, coalesce(abs(z_score) >= 2.5, false) AS z_o FROM fdr))"""
ROUND = "floor({0} * 1e8 + 0.5e0) / 1e8"


def r8(name: str):
    return rounded(F.col(name), 8).alias(name)


def s8(*names: str) -> str:
    return ", ".join(f"{ROUND.format(n)} AS {n}" for n in names)


STAT_COLS = ("cohort_mean", "cohort_std", "cohort_median", "cohort_q25", "cohort_q75", "cohort_min", "cohort_max", "cohort_IQR")
KEY = ("sample", "island_id", "haplotype")
KEYS = "sample, island_id, haplotype"


def counts_rollup(spark, d):
    return _counts(spark, d)


def depth_filtered_counts(spark, d):
    return _deep(spark, d)


def duplicate_key_audit(spark, d):
    return counts.duplicate_keys(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def cohort_locus_stats(spark, d):
    return _stats(spark, d).select("island_id", "haplotype", "cohort_n_samples", *map(r8, STAT_COLS))


def cohort_zscores(spark, d):
    deep = _deep(spark, d)
    return cohort.score_standard(deep, cohort.locus_stats(deep)).select(*KEY, "frac_meth", "z_score")


def cohort_loo_zscores(spark, d):
    return cohort.score_leave_one_out(_deep(spark, d)).select(*KEY, "frac_meth", "cohort_mean", *map(r8, ("cohort_std", "cohort_median", "cohort_q25", "cohort_q75", "cohort_IQR")), "z_score")


def pvalues_bh(spark, d):
    return _flagged(spark, d).select(*KEY, "z_score", r8("p_value"), r8("p_adj"))


def cohort_outliers(spark, d):
    """The flagship: flagged rows of the whole cohort run."""
    cols = [*KEY, "n_reads", "frac_meth", "cohort_n_samples", r8("cohort_mean"), r8("cohort_std"), "z_score", r8("p_value"), r8("p_adj"), "IQR_outlier", "Z_outlier", "outlier"]
    return cohort.sorted_outliers(_flagged(spark, d)).select(*cols)


def cohort_flagged(spark, d):
    return _flagged(spark, d).select(*KEY, "frac_meth", "z_score", r8("p_adj"), "IQR_outlier", "Z_outlier", "outlier")


def _listed(spark, d):
    return _t(spark, d, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("sample"))


def excluded_samples(spark, d):
    return counts.exclude_samples(_deep(spark, d), _listed(spark, d)).select(*KEY, "n_reads", "frac_meth")


def exclusion_audit(spark, d):
    return counts.exclusion_audit(_deep(spark, d), _listed(spark, d))


def _renamed(spark, d):
    hap = F.when(F.col("haplotype") == "A", "hap1").when(F.col("haplotype") == "R", "hap2").when(F.col("haplotype") == "N", "unphased").otherwise(F.col("haplotype"))
    return _counts(spark, d).withColumn("haplotype", hap)


def sample_qc_metrics(spark, d):
    return qc.sample_metrics(_renamed(spark, d))


def qc_flags(spark, d):
    flags = qc.qc_flags(qc.sample_metrics(_renamed(spark, d)), min_coverage_frac=0.99, meth_lo=0.45, meth_hi=0.6)
    return flags.select("sample", "coverage_frac", "mean_meth", "flag_coverage", "flag_meth", "qc_outlier", "qc_reasons")


def hap_delta_by_locus(spark, d):
    return views.haplotypic_delta(views.haplotypes_side_by_side(_renamed(spark, d))).select("island_id", r8("mean_delta"), r8("median_delta"), r8("std_delta"), "n_samples", "large")


def hap_scatter(spark, d):
    return views.haplotypes_side_by_side(_renamed(spark, d)).select("sample", "island_id", r8("hap1"), r8("hap2"), r8("delta"))


def genome_positions(spark, d):
    part = _t(spark, d, "part")
    chrom = F.concat(F.lit("chr"), (F.col("p_partkey") % 22 + 1).cast("string"))
    loci = part.select("p_partkey", chrom.alias("chrom"), (F.col("p_partkey") * 1000).alias("start"), (F.col("p_partkey") * 1000 + F.col("p_size") * 10).alias("end"))
    return intervals.genome_positions(loci, intervals.chrom_table(spark))


def manhattan_outlier_count(spark, d):
    return views.outliers_per_locus(_flagged(spark, d))


def outlier_scatter_topk(spark, d):
    return views.deviating(_flagged(spark, d), most=100).select(*KEY, "frac_meth", r8("cohort_mean"), "z_score", "outlier")


def topk_per_group(spark, d):
    rows = _flagged(spark, d).where("z_score IS NOT NULL")
    return views.top_per_group(rows, ["haplotype"], [F.abs("z_score").desc(), F.col("sample"), F.col("island_id")], 10).select(*KEY, "z_score", F.col("rank").cast("long").alias("rank"))


def heatmap_long(spark, d):
    return views.heatmap(_flagged(spark, d), most=10).select("island_id", "sample", r8("z"), rounded(F.col("row_mean"), 6).alias("row_mean"))


def locus_ordered(spark, d):
    stats = _stats(spark, d).where("haplotype = 'all'")
    return views.ordered_loci(stats).select("island_id", F.col("rank").cast("long").alias("rank"), r8("cohort_mean"), r8("err_up"), r8("err_down"))


def volcano_categories(spark, d):
    return views.volcano(_flagged(spark, d)).select(*KEY, r8("delta"), rounded(F.col("neg_logp"), 6).alias("neg_logp"), "category")


def sample_manhattan(spark, d):
    return views.sample_manhattan(_flagged(spark, d)).select(*KEY, rounded(F.col("signed_logp"), 6).alias("signed_logp"))


def color_limits(spark, d):
    return views.color_limit(_flagged(spark, d), "z_score").select(r8("cmax"))


def box_summary(spark, d):
    return views.box_summary(_t(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice").select("l_returnflag", "l_linestatus", "n", *[rounded(F.col(c), 6).alias(c) for c in ("low", "q25", "median", "q75", "high")])


def histogram(spark, d):
    return views.histogram(_t(spark, d, "lineitem"), "l_quantity", low=0.0, high=50.0, bins=20)


def _spans(spark, d):
    day = F.expr("date_diff(o_orderdate, date'1990-01-01')").cast("long")
    reads = _t(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("chrom"), day.alias("ref_start"), (day + 120).alias("ref_end"))
    islands = _t(spark, d, "orders").select(F.col("o_orderpriority").alias("chrom"), F.explode(F.sequence(F.lit(0), F.lit(119))).alias("island")).distinct()
    return reads, islands.select("chrom", "island", (F.col("island") * 30).cast("long").alias("start"), (F.col("island") * 30 + 30).cast("long").alias("end"))


def span_join(spark, d):
    reads, islands = _spans(spark, d)
    return intervals.span_join(reads, islands, bin_size=30).groupBy("chrom", "island").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


def interval_overlap_exclude(spark, d):
    _, islands = _spans(spark, d)
    outside, _ = intervals.split_par(islands, [(100, 800), (2000, 2100)])
    return outside


def call_counts(spark, d):
    calls = F.transform("embedding", lambda x, i: F.struct(i.alias("rpos"), x.alias("prob")))
    total, meth = counts.call_counts(calls, F.lit(0.0), F.lit(8), F.lit(56))
    return _t(spark, d, "embeddings").select("vec_id", "label", total.alias("n_total"), meth.alias("n_meth"))


def _reads(spark, d):
    made = call_counts(spark, d).where("n_total >= 10")
    return made.withColumn("classification", xci.classify_read(F.col("n_meth"), F.col("n_total"), 0.55)).withColumn("haplotype", (F.col("vec_id") % 3).cast("int"))


def read_classification(spark, d):
    return _reads(spark, d).select("vec_id", "n_total", "n_meth", "classification")


def _islands(spark, d):
    told = _reads(spark, d).withColumn("island_id", F.col("label").cast("string")).withColumn("island_chrom", F.lit("chrX")).withColumn("island_start", F.col("label").cast("long") * 1000).withColumn("island_end", F.col("label").cast("long") * 1000 + 300)
    return xci.per_island(told)


def island_conditional_agg(spark, d):
    return _islands(spark, d)


def hemi_methylated(spark, d):
    return xci.hemi_methylated(_islands(spark, d), min_reads=5, low=0.3, high=0.7).select("island_id", "meth_frac_combined")


def igv_status_rgb(spark, d):
    return xci.island_status(_islands(spark, d), min_reads=5, low=0.3, high=0.7).select("island_id", "status", "label", F.col("score").cast("long").alias("score"), "rgb")


def bed9_lines(spark, d):
    return xci.bed9(xci.island_status(_islands(spark, d), min_reads=5, low=0.3, high=0.7)).select("start", "line")


def sex_ratio(spark, d):
    events = _t(spark, d, "events").select((F.col("user_id") % 50).alias("sample"), F.when(F.col("event_type") == "click", "chrY").otherwise("chrX").alias("contig"), F.lit(1).alias("mapped"))
    return xci.sex_of(events, threshold=0.2).select("sample", "x_reads", "y_reads", rounded(F.col("y_ratio"), 8).alias("y_ratio"), "sex")


def kde_grid(spark, d):
    return xci.kde(_t(spark, d, "part").select((F.col("p_size") * 2).alias("pct")), points=101).select("i", rounded(F.col("x"), 6).alias("x"), rounded(F.col("density"), 8).alias("density"))


def gmm_fit(spark, d):
    fit = xci.gaussian_mixture(_t(spark, d, "part").select((F.col("p_size") * 2.0).alias("pct")), rounds=60)
    return spark.createDataFrame([(k, float(v)) for k, v in sorted((fit or {}).items())], "name string, value double").select("name", r8("value"))


def median_impute(spark, d):
    return qc.median_imputed(_deep(spark, d).where("haplotype <> 'all'")).select("sample", "island_id", r8("frac_meth"), "imputed")


def pca_mahalanobis(spark, d):
    few = _counts(spark, d).where("haplotype = 'all'")
    far = qc.mahalanobis(qc.principal_components(qc.median_imputed(few)))
    return far.select("sample", *[rounded(F.col(c), 6).alias(c) for c in ("pc1", "pc2", "mahal_dist")])


def mahalanobis_of_points(spark, d):
    points = _t(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("x"), "p_retailprice")
    return qc.mahalanobis(points, "x", "p_retailprice").select("p_partkey", rounded(F.col("mahal_dist"), 6).alias("mahal_dist"))


def exclude_text_parse(spark, d):
    from islet.sources.tables import exclude_names

    lines = _t(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return exclude_names(lines).groupBy().agg(F.count("*").alias("n"), F.sum(F.length("sample")).alias("chars"))


def sanitize_names(spark, d):
    return _t(spark, d, "pages").select("page_id", sanitized(F.col("url")).alias("name"))


def json_summary(spark, d):
    made = _counts(spark, d).groupBy("haplotype").agg(F.count("*").alias("n"), F.sum("n_reads").alias("reads"))
    return xci.summary_json(made)


def sample_summary(spark, d):
    return views.sample_summary(_flagged(spark, d))


#: Islands of the read tables, as SQL.
CALLS = """calls AS (SELECT vec_id, label, len(e) AS n_total, len(list_filter(e, lambda x: x >= 0)) AS n_meth FROM (SELECT vec_id, label, embedding[9:56] AS e FROM embeddings))
, reads AS (SELECT *, vec_id % 3 AS haplotype, CASE WHEN n_meth / n_total >= 0.55e0 THEN 'methylated' WHEN n_meth / n_total <= 1 - 0.55e0 THEN 'unmethylated' ELSE 'partial' END AS classification FROM calls WHERE n_total >= 10)"""


def _island_sql() -> str:
    aggs = []
    for name, hp in xci.HAPLOTYPES.items():
        aggs.append(f"count(*) FILTER (haplotype = {hp}) AS n_reads_{name}")
        aggs += [f"count(*) FILTER (haplotype = {hp} AND classification = '{c}') AS n_{short}_{name}" for short, c in (("meth", "methylated"), ("unmeth", "unmethylated"), ("partial", "partial"))]
    fracs = [f"floor(n_meth_{n} / nullif(n_meth_{n} + n_unmeth_{n}, 0) * 1e4 + 0.5e0) / 1e4 AS meth_frac_{n}" for n in xci.HAPLOTYPES]
    return f"""{CALLS}, islands AS (SELECT *, island_end - island_start AS island_length, floor((meth_frac_hap1 - meth_frac_hap2) * 1e4 + 0.5e0) / 1e4 AS delta_meth, floor(n_meth_total / nullif(n_informative_total, 0) * 1e4 + 0.5e0) / 1e4 AS meth_frac_combined FROM (
 SELECT *, {", ".join(fracs)}, n_meth_hap1 + n_unmeth_hap1 + n_meth_hap2 + n_unmeth_hap2 AS n_informative_total, n_meth_hap1 + n_meth_hap2 AS n_meth_total FROM (
 SELECT CAST(label AS VARCHAR) AS island_id, 'chrX' AS island_chrom, CAST(label AS BIGINT) * 1000 AS island_start, CAST(label AS BIGINT) * 1000 + 300 AS island_end, {", ".join(aggs)} FROM reads GROUP BY ALL)))"""


RENAMED = COUNTS + """, named AS (SELECT * REPLACE (CASE haplotype WHEN 'A' THEN 'hap1' WHEN 'R' THEN 'hap2' WHEN 'N' THEN 'unphased' ELSE haplotype END AS haplotype) FROM counts)
, sides AS (SELECT *, hap1 - hap2 AS delta FROM (SELECT sample, island_id, avg(frac_meth) FILTER (haplotype = 'hap1') AS hap1, avg(frac_meth) FILTER (haplotype = 'hap2') AS hap2 FROM named GROUP BY ALL) WHERE hap1 IS NOT NULL AND hap2 IS NOT NULL)"""
R4 = "floor({0} * 1e4 + 0.5e0) / 1e4"
METRICS = RENAMED + f""", metrics AS (SELECT *, {R4.format("n_loci_covered / n_loci_total")} AS coverage_frac FROM (SELECT sample, n_loci_covered, {R4.format("s / n / 1e4")} AS mean_meth, {R4.format("med")} AS median_meth, {R4.format(f"sqrt({VAR})")} AS std_meth,
  {R4.format("mr")} AS mean_reads, {R4.format("md")} AS median_reads, nullif(h1, 0) AS n_hap1_loci, nullif(h2, 0) AS n_hap2_loci, (SELECT count(DISTINCT island_id) FROM named) AS n_loci_total FROM (
 SELECT sample, count(DISTINCT island_id) FILTER (haplotype = 'all') AS n_loci_covered, count(f) FILTER (haplotype = 'all') AS n, CAST(sum(f) FILTER (haplotype = 'all') AS DOUBLE) AS s, CAST(sum(f * f) FILTER (haplotype = 'all') AS DOUBLE) AS q,
  quantile_cont(frac_meth, 0.5) FILTER (haplotype = 'all') AS med, avg(n_reads) FILTER (haplotype = 'all') AS mr, quantile_cont(n_reads, 0.5) FILTER (haplotype = 'all') AS md, count(DISTINCT island_id) FILTER (haplotype = 'hap1') AS h1,
  count(DISTINCT island_id) FILTER (haplotype = 'hap2') AS h2 FROM (SELECT *, CAST(round(frac_meth * 1e4) AS BIGINT) AS f FROM named) GROUP BY sample) WHERE n_loci_covered > 0))"""
_chrom_rows = ", ".join(f"('{n}', {i}, {sum(s for _, s in intervals.CHROM_SIZES[:i])})" for i, (n, _) in enumerate(intervals.CHROM_SIZES))
SPANS = """reads AS (SELECT o_orderkey, o_orderpriority AS chrom, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS ref_start FROM orders)
, islands AS (SELECT chrom, CAST(island AS INTEGER) AS island, island * 30 AS start, island * 30 + 30 AS "end" FROM (SELECT DISTINCT o_orderpriority AS chrom FROM orders), range(120) t(island))"""
LOO_VAR = "greatest(0e0, ((n - 1) * s2 - (frac_meth - mu) * (frac_meth - others)) / (n - 2))"

def _axis(of: str, n: int) -> str:
    """The leading eigenvector and value of a symmetric matrix in one row: squared 40 times it is all its leading axis."""
    times = lambda a, b: f"list_transform({a}, lambda r: list_transform({b}, lambda c: list_dot_product(r, c)))"
    size = "sqrt(list_sum(list_transform({0}, lambda r: list_dot_product(r, r))))"
    return f"""p{n}(i, m) AS (SELECT 0, g FROM {of} UNION ALL SELECT i + 1, list_transform(m2, lambda r: list_transform(r, lambda x: x / {size.format('m2')})) FROM (SELECT i, {times('m', 'm')} AS m2 FROM p{n} WHERE i < 40)),
 l{n} AS (SELECT list_transform(r, lambda x: x / sqrt(list_dot_product(r, r))) AS v FROM (SELECT arg_max(r, list_dot_product(r, r)) AS r FROM (SELECT unnest(m) AS r FROM p{n} WHERE i = 40))),
 v{n} AS (SELECT v, list_dot_product(v, list_transform(g, lambda r: list_dot_product(r, v))) AS e FROM l{n}, {of})"""


#: Principal components of rolled-up rows, medians where a sample lacks a locus: pcs, and what the axes carry.
COMPONENTS = f"""RECURSIVE {COUNTS}, known AS (SELECT sample, island_id, avg(frac_meth) AS v FROM counts WHERE haplotype = 'all' GROUP BY ALL), mid AS (SELECT island_id, quantile_cont(v, 0.5) AS m FROM known GROUP BY ALL),
 full_grid AS (SELECT sample, island_id, coalesce(v, m) AS v FROM mid CROSS JOIN (SELECT DISTINCT sample FROM known) LEFT JOIN known USING (sample, island_id)),
 x AS (SELECT sample, island_id, (v - avg(v) OVER w) / CASE WHEN stddev_pop(v) OVER w > 0 THEN stddev_pop(v) OVER w ELSE 1 END AS x FROM full_grid WINDOW w AS (PARTITION BY island_id)),
 xs AS (SELECT sample, list(x ORDER BY island_id) AS x FROM x GROUP BY sample),
 gram AS (SELECT list(r ORDER BY a) AS g FROM (SELECT a.island_id AS a, list(s ORDER BY b.island_id) AS r FROM (SELECT DISTINCT island_id FROM x) a, (SELECT DISTINCT island_id FROM x) b, LATERAL (SELECT sum(y.x * z.x) AS s FROM x y JOIN x z USING (sample) WHERE y.island_id = a.island_id AND z.island_id = b.island_id) GROUP BY 1)),
 {_axis("gram", 1)}, rest AS (SELECT list_transform(g, lambda r, i: list_transform(r, lambda c, j: c - e * v[i] * v[j])) AS g FROM gram, v1), {_axis("rest", 2)},
 raw AS (SELECT sample, list_dot_product(x, v1.v) AS a, list_dot_product(x, v2.v) AS b FROM xs, v1, v2),
 pcs AS (SELECT sample, a * sign(arg_max(a, abs(a)) OVER ()) AS pc1, b * sign(arg_max(b, abs(b)) OVER ()) AS pc2 FROM raw)"""

ORACLE = {
    "counts_rollup": f"WITH {COUNTS} SELECT * FROM counts",
    "depth_filtered_counts": f"WITH {DEEP} SELECT * FROM deep",
    "duplicate_key_audit": "SELECT count(*) AS repeated_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1",
    "cohort_locus_stats": f"WITH {STATS} SELECT island_id, haplotype, cohort_n_samples, {s8(*STAT_COLS)} FROM stats",
    "cohort_zscores": f"WITH {SCORED} SELECT {KEYS}, frac_meth, z_score FROM scored",
    "cohort_loo_zscores": f"WITH {DEEP}, m AS (SELECT *, s / n / 1e4 AS mu, {VAR} AS s2 FROM ({MOMENTS})), loo AS (SELECT *, CASE WHEN ns >= 5 AND n > 1 THEN (n * mu - frac_meth) / (n - 1) END AS others FROM deep LEFT JOIN m USING (island_id, haplotype)), told AS (SELECT *, floor(others * 1e6 + 0.5e0) / 1e6 AS cohort_mean, sqrt(CASE WHEN ns >= 5 AND n > 2 THEN {LOO_VAR} END) AS sd FROM loo) SELECT {KEYS}, frac_meth, cohort_mean, {ROUND.format('sd')} AS cohort_std, {', '.join(f'{ROUND.format(f"CASE WHEN ns >= 5 THEN {c} END")} AS cohort_{k}' for k, c in (('median', 'q50'), ('q25', 'q25'), ('q75', 'q75'), ('IQR', 'q75 - q25')))}, floor((frac_meth - cohort_mean) / CASE WHEN sd > 1e-9 THEN sd END * 1e4 + 0.5e0) / 1e4 AS z_score FROM told",
    "pvalues_bh": f"WITH {PVALUES} SELECT {KEYS}, z_score, {s8('p_value', 'p_adj')} FROM flagged",
    "cohort_outliers": f'WITH {PVALUES} SELECT {KEYS}, n_reads, frac_meth, cohort_n_samples, {s8("cohort_mean", "cohort_std")}, z_score, {s8("p_value", "p_adj")}, "IQR_outlier", "Z_outlier", outlier FROM flagged WHERE outlier',
    "cohort_flagged": f'WITH {PVALUES} SELECT {KEYS}, frac_meth, z_score, {s8("p_adj")}, "IQR_outlier", "Z_outlier", outlier FROM flagged',
    "excluded_samples": f"WITH {DEEP} SELECT {KEYS}, n_reads, frac_meth FROM deep WHERE sample NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)",
    "exclusion_audit": f"WITH {DEEP} SELECT s_suppkey AS sample, s_suppkey IN (SELECT sample FROM deep) AS found FROM supplier WHERE s_acctbal < 0",
    "sample_qc_metrics": f"WITH {METRICS} SELECT * FROM metrics",
    "qc_flags": f"WITH {METRICS} SELECT sample, coverage_frac, mean_meth, fc AS flag_coverage, fm AS flag_meth, fc OR fm AS qc_outlier, concat_ws(' ', CASE WHEN fc THEN 'low_coverage' END, CASE WHEN fm THEN 'atypical_methylation' END) AS qc_reasons FROM (SELECT *, coalesce(coverage_frac < 0.99, false) AS fc, coalesce(mean_meth < 0.45 OR mean_meth > 0.6, false) AS fm FROM metrics)",
    "hap_delta_by_locus": f"WITH {RENAMED} SELECT island_id, {s8('mean_delta', 'median_delta')}, {ROUND.format(f'sqrt({VAR})')} AS std_delta, n_samples, mean_delta >= 0.5 AS large FROM (SELECT *, s / n / 1e4 AS mean_delta FROM (SELECT island_id, count(f) AS n, CAST(sum(f) AS DOUBLE) AS s, CAST(sum(f * f) AS DOUBLE) AS q, quantile_cont(x, 0.5) AS median_delta, count(DISTINCT sample) AS n_samples FROM (SELECT *, CAST(round(x * 1e4) AS BIGINT) AS f FROM (SELECT *, floor(abs(delta) * 1e4 + 0.5e0) / 1e4 AS x FROM sides)) GROUP BY island_id))",
    "hap_scatter": f"WITH {RENAMED} SELECT sample, island_id, {s8('hap1', 'hap2', 'delta')} FROM sides",
    "genome_positions": f'WITH c(chrom, ord, o) AS (VALUES {_chrom_rows}) SELECT chrom, p_partkey, "start", "end", ord, o + ("start" + "end") // 2 AS x_pos FROM (SELECT p_partkey, \'chr\' || (p_partkey % 22 + 1) AS chrom, p_partkey * 1000 AS "start", p_partkey * 1000 + p_size * 10 AS "end" FROM part) JOIN c USING (chrom)',
    "manhattan_outlier_count": f"WITH {PVALUES} SELECT island_id, n_outliers, mean_z, floor(greatest(4e0, least(18e0, 4 + 3 * ln(1 + n_outliers))) * 1e4 + 0.5e0) / 1e4 AS size FROM (SELECT island_id, count(DISTINCT sample) AS n_outliers, floor(CAST(sum(CAST(round(z_score * 1e4) AS BIGINT)) AS DOUBLE) / CAST(count(z_score) AS DOUBLE) + 0.5e0) / 1e4 AS mean_z FROM flagged WHERE outlier AND (haplotype = 'all' OR NOT EXISTS (SELECT 1 FROM flagged WHERE outlier AND haplotype = 'all')) GROUP BY island_id)",
    "outlier_scatter_topk": f"WITH {PVALUES} SELECT {KEYS}, frac_meth, {s8('cohort_mean')}, z_score, outlier FROM flagged WHERE z_score IS NOT NULL AND cohort_mean IS NOT NULL AND (outlier OR abs(z_score) >= 2.5) ORDER BY abs(z_score) DESC, sample, island_id, haplotype LIMIT 100",
    "topk_per_group": f"WITH {PVALUES} SELECT {KEYS}, z_score, rank FROM (SELECT *, row_number() OVER (PARTITION BY haplotype ORDER BY abs(z_score) DESC, sample, island_id) AS rank FROM flagged WHERE z_score IS NOT NULL) WHERE rank <= 10",
    "heatmap_long": f"WITH {PVALUES}, top AS (SELECT island_id FROM flagged WHERE haplotype = 'all' GROUP BY island_id ORDER BY count(DISTINCT sample) FILTER (outlier) DESC, island_id LIMIT 10) SELECT island_id, sample, {s8('z')}, floor(row_mean * 1e6 + 0.5e0) / 1e6 AS row_mean FROM (SELECT *, avg(z) OVER (PARTITION BY island_id) AS row_mean FROM (SELECT island_id, sample, avg(z_score) AS z FROM flagged WHERE haplotype = 'all' AND z_score IS NOT NULL AND island_id IN (FROM top) GROUP BY ALL))",
    "locus_ordered": f"WITH {STATS} SELECT island_id, row_number() OVER (ORDER BY cohort_mean, island_id) - 1 AS rank, {s8('cohort_mean')}, {ROUND.format('greatest(cohort_q75 - cohort_mean, 0e0)')} AS err_up, {ROUND.format('greatest(cohort_mean - cohort_q25, 0e0)')} AS err_down FROM stats WHERE haplotype = 'all' AND cohort_mean IS NOT NULL",
    "volcano_categories": f"WITH {PVALUES} SELECT {KEYS}, {s8('delta')}, floor(least(50e0, -log10(greatest(p_value, 1e-300))) * 1e6 + 0.5e0) / 1e6 AS neg_logp, CASE WHEN p_value < 0.05 AND delta > 0.1e0 THEN 'hyper' WHEN p_value < 0.05 AND delta < -0.1e0 THEN 'hypo' WHEN p_value < 0.05 THEN 'sig' ELSE 'ns' END AS category FROM (SELECT *, frac_meth - cohort_mean AS delta FROM flagged WHERE p_value IS NOT NULL AND cohort_mean IS NOT NULL)",
    "sample_manhattan": f"WITH {PVALUES} SELECT {KEYS}, floor(sign(z_score) * -log10(greatest(p_adj, 1e-300)) * 1e6 + 0.5e0) / 1e6 AS signed_logp FROM flagged WHERE haplotype = 'all' AND p_adj IS NOT NULL",
    "color_limits": f"WITH {PVALUES} SELECT {ROUND.format('greatest(coalesce(quantile_cont(abs(z_score), 0.99), 1e0), 1e0)')} AS cmax FROM flagged",
    "box_summary": "SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, " + ", ".join(f"floor(quantile_cont(l_extendedprice, {q}) * 1e6 + 0.5e0) / 1e6 AS {n}" for n, q in (("low", 0), ("q25", 0.25), ("median", 0.5), ("q75", 0.75), ("high", 1))) + " FROM lineitem GROUP BY ALL",
    "histogram": "SELECT CAST(least(floor(l_quantity / 2.5e0) + 1, 20) AS BIGINT) AS bin, count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 0 AND 50 GROUP BY 1",
    "span_join": f'WITH {SPANS} SELECT chrom, island, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM reads JOIN islands USING (chrom) WHERE ref_start <= start AND ref_start + 120 >= "end" GROUP BY ALL',
    "interval_overlap_exclude": f'WITH {SPANS} SELECT * FROM islands WHERE NOT ((start < 800 AND "end" > 100) OR (start < 2100 AND "end" > 2000))',
    "call_counts": f"WITH {CALLS} SELECT * FROM calls",
    "read_classification": f"WITH {CALLS} SELECT vec_id, n_total, n_meth, classification FROM reads",
    "island_conditional_agg": f"WITH {_island_sql()} SELECT * FROM islands",
    "hemi_methylated": f"WITH {_island_sql()} SELECT island_id, meth_frac_combined FROM islands WHERE n_meth_hap1 + n_unmeth_hap1 >= 5 AND n_meth_hap2 + n_unmeth_hap2 >= 5 AND meth_frac_combined BETWEEN 0.3 AND 0.7",
    "sex_ratio": "SELECT sample, x_reads, y_reads, floor(y_reads / (x_reads + y_reads) * 1e8 + 0.5e0) / 1e8 AS y_ratio, CASE WHEN y_reads / (x_reads + y_reads) > 0.2e0 THEN 'M' ELSE 'F' END AS sex FROM (SELECT user_id % 50 AS sample, count(*) FILTER (event_type <> 'click') AS x_reads, count(*) FILTER (event_type = 'click') AS y_reads FROM events GROUP BY 1)",
    "kde_grid": "WITH v AS (SELECT p_size * 2e0 AS v FROM part), m AS (SELECT count(*) AS n, stddev_samp(v) * power(count(*), -1e0 / 5) AS w FROM v) SELECT CAST(i AS INTEGER) AS i, floor(i * 1e0 * 1e6 + 0.5e0) / 1e6 AS x, floor(sum(exp(-0.5e0 * power((i - v) / w, 2))) / (min(n) * min(w) * sqrt(2 * pi())) * 1e8 + 0.5e0) / 1e8 AS density FROM v, m, range(101) g(i) GROUP BY i",
    "median_impute": f"WITH {DEEP}, known AS (SELECT sample, island_id, avg(frac_meth) AS v FROM deep WHERE haplotype <> 'all' GROUP BY ALL), mid AS (SELECT island_id, quantile_cont(v, 0.5) AS m FROM known GROUP BY ALL) SELECT sample, island_id, {ROUND.format('coalesce(v, m)')} AS frac_meth, v IS NULL AS imputed FROM mid CROSS JOIN (SELECT DISTINCT sample FROM known) LEFT JOIN known USING (sample, island_id)",
    "pca_mahalanobis": f"""WITH {COMPONENTS}, m AS (SELECT avg(pc1) AS mx, avg(pc2) AS my, var_samp(pc1) AS vx, var_samp(pc2) AS vy, covar_samp(pc1, pc2) AS c FROM pcs)
 SELECT sample, {', '.join(f"floor({x} * 1e6 + 0.5e0) / 1e6 AS {n}" for n, x in (("pc1", "pc1"), ("pc2", "pc2"), ("mahal_dist", "sqrt(greatest(((pc1 - mx) * (pc1 - mx) * vy - 2e0 * (pc1 - mx) * (pc2 - my) * c + (pc2 - my) * (pc2 - my) * vx) / (vx * vy - c * c), 0e0))")))} FROM pcs, m""",
    "mahalanobis_of_points": "SELECT p_partkey, floor(sqrt(greatest((dx * dx * vy - 2e0 * dx * dy * c + dy * dy * vx) / (vx * vy - c * c), 0e0)) * 1e6 + 0.5e0) / 1e6 AS mahal_dist FROM (SELECT p_partkey, p_size - mx AS dx, p_retailprice - my AS dy, vx, vy, c FROM part, (SELECT avg(p_size) AS mx, avg(p_retailprice) AS my, var_samp(p_size) AS vx, var_samp(p_retailprice) AS vy, covar_samp(p_size, p_retailprice) AS c FROM part))",
    "exclude_text_parse": "SELECT count(*) AS n, CAST(sum(length(sample)) AS BIGINT) AS chars FROM (SELECT DISTINCT trim(split_part(value, '#', 1), ' \t\r\n\f\v') AS sample FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)) WHERE sample <> ''",
    "sanitize_names": "SELECT page_id, substring(regexp_replace(regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 80) AS name FROM pages",
}

QUERIES = {
    f.__name__: f
    for f in (
        counts_rollup, depth_filtered_counts, duplicate_key_audit, cohort_locus_stats, cohort_zscores, cohort_loo_zscores, pvalues_bh, cohort_outliers, cohort_flagged, excluded_samples, exclusion_audit,
        sample_qc_metrics, qc_flags, hap_delta_by_locus, hap_scatter, genome_positions, manhattan_outlier_count, outlier_scatter_topk, topk_per_group, heatmap_long, locus_ordered, volcano_categories,
        sample_manhattan, color_limits, box_summary, histogram, span_join, interval_overlap_exclude, call_counts, read_classification, island_conditional_agg, hemi_methylated, igv_status_rgb, bed9_lines,
        sex_ratio, kde_grid, gmm_fit, median_impute, pca_mahalanobis, mahalanobis_of_points, exclude_text_parse, sanitize_names, json_summary, sample_summary,
    )
}
