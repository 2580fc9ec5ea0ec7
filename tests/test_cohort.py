"""Cohort statistics, scores, p-values and flags against small known cases and plain recomputation."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from islet.functions.numeric import sanitized, two_sided_p
from islet.operators import cohort, counts, qc
from pyspark.sql import functions as F

X = [0.10, 0.20, 0.30, 0.40, 0.90]


def table(spark, groups):
    rows = [(f"s{i}", locus, hap, float(v) if v is not None else None) for (locus, hap), values in groups.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "sample string, island_id string, haplotype string, frac_meth double")


def test_pooled(spark):
    df = table(spark, {("a", "all"): X, ("flat", "all"): [0.5] * 6, ("few", "all"): X[:4], ("one", "all"): [0.3]})
    stats = cohort.locus_stats(df)
    got = {r.island_id: r for r in stats.collect()}
    assert (got["a"].cohort_mean, got["a"].cohort_std) == (pytest.approx(0.38), pytest.approx(0.311448, abs=1e-6))
    assert (got["a"].cohort_q25, got["a"].cohort_median, got["a"].cohort_q75) == (pytest.approx(0.2), pytest.approx(0.3), pytest.approx(0.4))
    assert got["few"].cohort_mean is None and got["few"].cohort_max == pytest.approx(0.4) and got["one"].cohort_std is None
    flagged = cohort.add_pvalues_and_flags(cohort.score_standard(df, stats)).collect()
    z = {(r.island_id, r.sample): r for r in flagged}
    assert [z["a", f"s{i}"].z_score for i in range(5)] == pytest.approx([-0.8990, -0.5779, -0.2569, 0.0642, 1.6696], abs=1e-4)
    assert [r.sample for r in flagged if r.island_id == "a" and r.IQR_outlier] == ["s4"]
    for k in ("flat", "few", "one"):
        r = z[k, "s0"]
        assert r.z_score is None and r.p_value is None and r.p_adj is None and r.outlier is False


def test_null_names_are_groups(spark):
    df = table(spark, {(None, "all"): X})
    assert cohort.locus_stats(df).first().cohort_n_samples == 5


def test_leave_one_out(spark):
    df = table(spark, {("a", "all"): X})
    rows = sorted(cohort.score_leave_one_out(df).collect(), key=lambda r: r.sample)
    assert [r.cohort_mean for r in rows] == pytest.approx([0.45, 0.425, 0.40, 0.375, 0.25])
    assert [r.cohort_std for r in rows] == pytest.approx([0.310913, 0.340343, 0.355903, 0.359398, 0.129099], abs=1e-6)
    assert [r.z_score for r in rows] == pytest.approx([-1.1257, -0.6611, -0.2810, 0.0696, 5.0349], abs=1e-4)
    old = sorted(cohort.score_leave_one_out(df, compat=True).collect(), key=lambda r: r.sample)
    assert [r.cohort_std for r in old] == pytest.approx([0.297489, 0.335348, 0.354965, 0.359340, 0], abs=1e-6)
    assert old[4].z_score is None


def test_leave_one_out_is_recomputation(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.random(12), 4)
    rows = sorted(cohort.score_leave_one_out(table(spark, {("a", "all"): x})).collect(), key=lambda r: int(r.sample[1:]))
    for i, r in enumerate(rows):
        rest = np.delete(x, i)
        assert (r.cohort_mean, r.cohort_std) == (pytest.approx(rest.mean(), abs=1e-6), pytest.approx(rest.std(ddof=1), abs=1e-6))


def bh(p):
    known = sorted((v, i) for i, v in enumerate(p) if v is not None)
    out, low = [None] * len(p), 1.0
    for rank in range(len(known), 0, -1):
        v, i = known[rank - 1]
        low = min(low, v * len(known) / rank)
        out[i] = low
    return out


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from([0.0, 0.04, 0.5, 1.0]), st.floats(0, 1)), min_size=1, max_size=30))
def test_bh(spark, p):
    df = spark.createDataFrame([(i, g, v) for g in ("a", None) for i, v in enumerate(p)], "i int, haplotype string, p_value double")
    want = bh(p)
    for bins in (4096, 2):
        for r in cohort.bh_fdr(df, bins=bins).collect():
            assert r.p_adj == (pytest.approx(want[r.i], rel=1e-12) if want[r.i] is not None else None)


def test_bh_row_order(spark):
    df = spark.createDataFrame([(i, "a", v) for i, v in enumerate([0.9, 0.001, 0.5, 0.04])], "i int, haplotype string, p_value double")
    got = [r.p_adj for r in cohort.bh_row_order(df, order=["i"]).orderBy("i").collect()]
    assert got == pytest.approx([0.004, 0.004, 0.08, 0.08])


def test_p_values(spark):
    z = [0.0, 1.0, 1.96, 2.5, -5.0, 10.0, None]
    got = [r.p for r in spark.createDataFrame([(i, v) for i, v in enumerate(z)], "i int, z double").select("i", two_sided_p(F.col("z")).alias("p")).orderBy("i").collect()]
    assert got[-1] is None and got[:-1] == pytest.approx([math.erfc(abs(v) / 2**0.5) for v in z[:-1]], rel=2e-7)


def test_rollup_and_filters(spark):
    reads = spark.createDataFrame([("s", "i", "hap1", 10, 5), ("s", "i", "hap1", 5, 5), ("s", "i", "unphased", 3, 0), ("s", "j", "hap2", 0, 0)], "sample string, island_id string, haplotype string, n_total int, n_meth int")
    got = {(r.island_id, r.haplotype): (r.n_reads, r.n_cpg_total, r.n_cpg_meth, r.n_cpg_unmeth, r.frac_meth) for r in counts.rollup_counts(reads).collect()}
    assert got == {("i", "hap1"): (2, 15, 10, 5, 0.6667), ("i", "unphased"): (1, 3, 0, 3, 0.0), ("i", "all"): (3, 18, 10, 8, 0.5556)}
    names = spark.createDataFrame([("s",), ("nobody",)], "sample string")
    assert counts.exclude_samples(reads, names).count() == 0
    assert {r.sample: r.found for r in counts.exclusion_audit(reads, names).collect()} == {"s": True, "nobody": False}
    assert counts.duplicate_keys(reads, ["sample", "island_id"]).first().asDict() == {"repeated_keys": 1, "extra_rows": 2}


def test_mahalanobis(spark):
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (1, 0), (0, 1), (1, 1), (4, 3)])], "i int, pc1 double, pc2 double")
    assert [r.mahal_dist for r in qc.mahalanobis(df).orderBy("i").collect()] == pytest.approx([0.818, 1.444, 1.479, 0.246, 1.731], abs=1e-3)
    assert qc.mahalanobis(df.limit(2)).first().mahal_dist == 0.0


def test_embedding_and_flags(spark):
    rng = np.random.default_rng(2)
    x = rng.random((6, 9)).round(4)
    x[5] += 3
    rows = [(f"s{i}", f"l{j}", "all", float(v)) for i, row in enumerate(x) for j, v in enumerate(row) if (i, j) != (0, 0)]
    filled = qc.median_imputed(spark.createDataFrame(rows, "sample string, island_id string, haplotype string, frac_meth double"))
    got = {(r.sample, r.island_id): r for r in filled.collect()}
    assert len(got) == 54 and got["s0", "l0"].imputed and got["s0", "l0"].frac_meth == pytest.approx(np.median(x[1:, 0]))
    x[0, 0] = np.median(x[1:, 0])
    scaled = (x - x.mean(0)) / x.std(0)
    u, s, _ = np.linalg.svd(scaled, full_matrices=False)
    pcs = {r.sample: (r.pc1, r.pc2) for r in qc.principal_components(filled).collect()}
    assert np.abs([pcs[f"s{i}"] for i in range(6)]) == pytest.approx(np.abs(u[:, :2] * s[:2]), abs=1e-6)
    metrics = spark.createDataFrame([("a", 3.2, 0.4, 0.95), ("b", None, None, 0.5)], "sample string, mahal_dist double, coverage_frac double, mean_meth double")
    flags = {r.sample: r for r in qc.qc_flags(metrics).collect()}
    assert flags["a"].qc_reasons == "embedding_outlier low_coverage atypical_methylation" and not flags["b"].qc_outlier and flags["b"].qc_reasons == ""


def test_sanitized(spark):
    assert spark.range(1).select(sanitized(F.lit("chr1:10-20__x"))).first()[0] == "chr1_10-20_x"


def test_components_of_many_samples(spark, monkeypatch):
    import numpy as np
    from pyspark.sql.classic.dataframe import DataFrame

    values = np.random.default_rng(3).random((60, 4)) * [1, 3, 2, 1] + np.arange(60)[:, None] * [0.02, 0.1, 0, 0]
    values[:, 3] = 0.5
    rows = [(f"s{i}", f"l{j}", "all", float(v)) for i, row in enumerate(values) for j, v in enumerate(row)]
    table = spark.createDataFrame(rows, "sample string, island_id string, haplotype string, frac_meth double").cache()
    most, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: most.append(got := collect(self)) or got)
    made = qc.principal_components(qc.median_imputed(table))
    assert max(map(len, most), default=0) <= 26 * 26  # the products of the thin matrix's columns, whatever the samples
    got = {r.sample: (r.pc1, r.pc2) for r in collect(made)}
    sd = values.std(0)
    x = (values - values.mean(0)) / np.where(sd > 1e-9, sd, 1)
    u, d, _ = np.linalg.svd(x, full_matrices=False)
    want = u[:, :2] * d[:2]
    want *= np.where(want[np.abs(want).argmax(0), range(2)] < 0, -1, 1)
    assert np.allclose([got[f"s{i}"] for i in range(60)], want, atol=1e-8)


def test_null_keys_are_scored(spark):
    df = table(spark, {(None, "all"): X, ("a", None): X, ("a", "all"): X[::-1]})
    for scored in (cohort.score_standard(df, cohort.locus_stats(df)), cohort.score_leave_one_out(df)):
        rows = scored.collect()
        assert len(rows) == 15 and all(r.z_score is not None and r.cohort_n_samples == 5 for r in rows)
        by = {(r.island_id, r.haplotype, r.frac_meth): r.z_score for r in rows}
        assert all(by[None, "all", x] == by["a", None, x] == by["a", "all", x] for x in X)


def test_two_names_of_a_locus_fail(spark):
    from islet.plans.runs import cohort_run
    from islet.sources.tables import COUNTS

    row = lambda i, name: (f"s{i}", "a", name, "chr1", 1, 9, 20, "all", 30, 30, 3 * i, 30 - 3 * i, i / 10)
    one = spark.createDataFrame([row(i, "x") for i in range(8)], COUNTS)
    stats, scored = cohort_run(one)
    assert stats.count() == 1 and stats.first().island_name == "x" and scored.count() == 8
    two = spark.createDataFrame([row(i, "xy"[i % 2]) for i in range(8)], COUNTS)
    with pytest.raises(Exception, match="several attributes"):
        cohort_run(two)[0].collect()
    nameless = spark.createDataFrame([row(i, None) for i in range(8)], COUNTS)
    assert all(r.z_score is not None for r in cohort_run(nameless)[1].collect())


def test_made_once(spark):
    """Quantiles make their table once and adjusted p twice, however many steps go over it; the cohort's rows come from counts that are written once."""
    import islet.queries as q
    from islet.operators import ranks

    seen = spark.sparkContext.accumulator(0)

    def work(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(500).selectExpr("id % 2 AS haplotype", "cast((id * 37) % 251 AS double) / 300 AS p_value").mapInArrow(work, "haplotype long, p_value double")
    got = {r.haplotype: r.q for r in ranks.exact_quantiles(df, ["haplotype"], "p_value", [0.5], rows=20, edges=4).collect()}
    assert seen.value == 500
    rows = [((i * 37) % 251 / 300, i % 2) for i in range(500)]
    assert got == {h: [pytest.approx(float(np.quantile([p for p, g in rows if g == h], 0.5)))] for h in (0, 1)}
    assert cohort.bh_fdr(df).where("p_adj >= p_value").count() == 500 and seen.value <= 1500
    assert not any("lineitem" in f or "part.parquet" in f for f in q._flagged(spark, "/root/testdata/sf0.001").inputFiles())


def test_scored_files_count_once(spark, monkeypatch):
    """The cohort run's files all come from one table of counts, and each is read in one pass."""
    import islet.queries as q
    from islet import view_queries

    made, real = [], q._counts
    monkeypatch.setattr(q, "_counts", lambda *a: made.append(1) or real(*a))
    got = view_queries.scored_files(spark, "/root/testdata/sf0.001")
    assert len(made) == 1 and got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3
    n = {r.name: r.n for r in got.collect()}
    assert set(n) == {"scored", "stats", "outliers", "flagged"} and n["outliers"] == n["flagged"] <= n["scored"]


def test_batches_made_once(spark, tmp_path):
    """Adding a batch to the states makes it once, and what came before isn't sent to all by the driver."""
    from islet.streaming.incremental import CohortStates

    seen, schema = spark.sparkContext.accumulator(0), "sample string, island_id string, haplotype string, frac_meth double"

    def work(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = table(spark, {("a", "all"): X, ("b", None): X}).mapInArrow(work, schema)
    states = CohortStates(spark, str(tmp_path / "c"))
    assert [states.add(df, 0), states.add(df, 1)] == [0, 10] and seen.value == 20
    assert [r.cohort_n_samples for r in states.stats().collect()] == [5, 5]


def test_store_of_a_table(spark, tmp_path):
    """With ``as_table`` the samples to make are a table, and inputs are evaluated once."""
    from islet.sources import tables

    made, names = [], [k.split(" ")[0] for k in tables.COUNTS.split(", ")]
    every = spark.createDataFrame([(f"s{i}", "i", None, "chr1", 1, 2, 3, "all", 7, 2, 1, 1, 0.5) for i in range(6)], tables.COUNTS)

    def make(samples):
        made.append(samples.columns)
        return every.join(samples, "sample", "left_semi").select(names)

    get = lambda n: {r.sample for r in tables.stored_counts(spark.createDataFrame([(f"s{i}", "a") for i in range(n)], "sample string, mark string"), str(tmp_path / "s"), {}, make, as_table=True).collect()}
    assert get(3) == {"s0", "s1", "s2"} and get(7) == {f"s{i}" for i in range(6)} and get(7) == {f"s{i}" for i in range(6)}
    assert made == [["sample"]] * 2
