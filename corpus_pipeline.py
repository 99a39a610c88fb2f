"""From raw documents to packed sequences: five stages, each stored before the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from conceptree.functions.tables import union_all
from conceptree.llm.blocks import free_name
from conceptree.llm.langid import UNKNOWN_LANGUAGE, fit, identify
from conceptree.llm.linededup import remove_shared_lines
from conceptree.llm.mixing import mixed_documents
from conceptree.llm.neardup import near_duplicates
from conceptree.llm.packing import pack
from conceptree.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; those without a letter go.

    A text stays however unsure its language is, as a few words may fit several. If no document has
    a lang, nothing can be told apart and likewise only texts without a letter go.
    """
    model = fit(docs)
    language = free_name(docs, "_lang_pred")
    marked = identify(docs, model, names=(language, free_name(docs, "_score")))
    if model.languages:
        kept = marked.where(F.col(language) != UNKNOWN_LANGUAGE)
    else:
        kept = marked.where(F.col("text").rlike("\\p{L}"))
    return kept.select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that an earlier document holds; documents that lose every word go.

    A null or empty text stays; for repeated rows and empty tables see ``remove_shared_lines``.
    """
    return remove_shared_lines(docs, drop_emptied=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, similarity 0.8), the smallest doc_id.

    Rows without a doc_id stay, as do texts that are null or have no word; rows that repeat a doc_id go or stay together.
    """
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id")
    held = docs.join(materialize(kept, "kept_ids"), "doc_id", "left_semi").select(*docs.columns)
    return union_all(held, docs.where("doc_id is null"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as came in, sources flattened towards 0.9 of the greatest entropy; small ones are drawn up to 4 times.

    Null is a source; documents without a word have no tokens to be drawn for, nor have empty tables.
    """
    return mixed_documents(docs, entropy=0.9, max_repeats=4.0, steepest=1.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences; a null text is packed as its end alone, an empty table gives none."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Neither the model of the first stage nor tokens can be expressed. Whole results have no brute force: tests check parts of the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
