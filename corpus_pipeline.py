"""A corpus pipeline of the training-data operators: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from islet.llm.common import keep, table
from islet.llm.decontaminate import find_items
from islet.llm.jaccard import one_of_each
from islet.llm.mixing import mix_to_targets
from islet.llm.quality import line_frequency_rules
from islet.llm.secrets import link_credentials


def _with_text(judged: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` with the text replaced and its length kept true."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return judged.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; of the others the frequent lines go."""
    return _with_text(line_frequency_rules(docs).where("kept"), docs, "clean_text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one stays."""
    return one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select(*docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is blanked; documents stay."""
    return _with_text(link_credentials(docs), docs, "redacted")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture samples, with their weights."""
    return mix_to_targets(docs).where("sampled").drop("sampled")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing),
]

#: Edit distances, links between sets and fitted weights are not for SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
