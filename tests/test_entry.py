import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def test_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["counts_rollup", "cohort_outliers", "cohort_loo_zscores", "span_join", "igv_status_rgb", "median_impute", "sample_manhattan_points", "track_rows", "xci_summary_numbers", "exclusion_file", "scored_files", "gmm_fit", "counts_by_header", "stored_counts", "price_quantiles", "largest_orders", "locus_distributions_whole", "pca_mahalanobis", "alignment_counts", "incremental_cohort", "outliers_in_order"])
def test_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as e

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{f}')")
    want = con.sql(e.oracle_sql()[name])
    df = e.queries()[name](spark, SF)
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    rows = lambda names, found: sorted((tuple(r[names.index(c)] for c in cols) for r in found), key=str)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())


def test_without_the_training_data_part(tmp_path):
    shutil.copytree(REPO, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"], cwd=tmp_path / "r", capture_output=True, text=True)
    assert said.stdout.split()[-1] == "False", said.stderr
