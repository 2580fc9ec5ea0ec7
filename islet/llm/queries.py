"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from islet.llm.chat import collapse_snapshots
from islet.llm.common import keep, table
from islet.llm.decontaminate import find_items
from islet.llm.jaccard import jaccard_join
from islet.llm.lm import cross_entropy_difference
from islet.llm.mixing import mix_to_targets
from islet.llm.oracles import ORACLE  # noqa: F401
from islet.llm.pieces import encode_pieces
from islet.llm.pii import replace_entities
from islet.llm.quality import line_frequency_rules
from islet.llm.repair import damage, repair_blocks, reports
from islet.llm.secrets import BASE, KINDS, joined, link_credentials
from islet.llm.suffixes import remove_repeats
from islet.llm.urls import filter_urls
from islet.llm.variants import spelling_variants

#: The vocabulary of the query contract.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Fixed values of the query contract.
URL_RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs).select("doc_id", "n_entities", F.col("surrogate_text").alias("text"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    judged = line_frequency_rules(docs, copies_count=True)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = cross_entropy_difference(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "n_tokens", "loss_target", "loss_background", "score")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_snapshots(table(spark, sf_dir, "conversations"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join(docs).select("doc_id", "n_shingles", "component_id")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mix_to_targets(docs)
    return mixed.select("doc_id", "source", "lang", "mix_topic", "n_tokens", "weight", "probability", "sampled")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = link_credentials(docs)
    count = lambda k: F.size(F.filter("base_spans", lambda x: x["k"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(F.col("base_spans")), 256).alias("base_sha256"), joined(F.col("all_spans")).alias("spans"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    blocks = keep(repair_blocks(damage(rows)).drop("edits"))
    return reports(rows, blocks).withColumnRenamed("digest", "repaired_sha256")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_variants(docs, typos=97)


def op13_sentencepiece(spark: SparkSession, sf_dir: str, model_file: str = PIECE_MODEL) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encode_pieces(docs, model_file).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {q.__name__: q for q in (op1_pii_surrogates, op2_lm_scoring, op3_url_filters, op4_chat_formatting, op5_ngram_jaccard_join, op6_mixing, op7_secret_scans, op8_suffix_array_dedup, op9_benchmark_decontamination, op10_quality_rules, op11_conversation_repair, op12_spelling_variants, op13_sentencepiece)}
