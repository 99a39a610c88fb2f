"""One query per training-data operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from conceptree.llm import oracle
from conceptree.llm.alignment import align_tokenizers
from conceptree.llm.audit import audit_filters
from conceptree.llm.ctw import score_texts
from conceptree.llm.langid import identify_languages
from conceptree.llm.linededup import remove_shared_lines
from conceptree.llm.mixing import mix_sources, word_count
from conceptree.llm.neardup import near_duplicates
from conceptree.llm.packing import pack
from conceptree.llm.passages import remove_repeated_passages
from conceptree.llm.quality import score_quality
from conceptree.llm.rules import quality_rules
from conceptree.llm.topk import exact_top_k
from conceptree.llm.warc import new_folder, read_pages, write_pages


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = write_pages(_table(spark, folder, "pages"), new_folder(spark))
    return read_pages(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_langid(spark: SparkSession, folder: str) -> DataFrame:
    return identify_languages(_table(spark, folder, "documents"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", word_count().alias("n_words"))
    left = remove_shared_lines(docs)
    return left.select(
        "doc_id", "n_words", word_count().alias("n_words_left"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(_table(spark, folder, "documents"), entropy=0.95, max_repeats=4.0)


def op6_passages(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated_passages(_table(spark, folder, "documents"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"))


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    return exact_top_k(_table(spark, folder, "embeddings"))


def op9_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"), shingle=4, percent=80)


def op10_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules(_table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op12_ctw(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(_table(spark, folder, "documents"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokenizers(_table(spark, folder, "documents"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_warc, op2_langid, op3_line_dedup, op4_quality, op5_mixing,
        op6_passages, op7_packing, op8_topk, op9_neardup, op10_rules, op11_audit, op12_ctw, op13_alignment,
    )
    return {**{f.__name__: f for f in named}, "pipeline": corpus_pipeline.run}


def llm_oracles() -> dict[str, str]:
    return oracle.SQL
