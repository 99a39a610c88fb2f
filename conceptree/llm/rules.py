"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he", "are", "this", "or", "at",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch", "es",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "en", "est", "que", "qui", "dans", "pour", "par", "sur", "au", "pas", "ne",
    "el", "los", "las", "del", "y", "se", "no", "por", "con", "su", "para", "lo", "una",
]


@dataclass(frozen=True)
class Rule:
    """``measure``, a column of ``measures``, must lie between ``least`` and ``most`` where given."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


RULES = [
    Rule("length", "n_words", least=50),
    Rule("mean_word_length", "word_length", least=2.0, most=14.0),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("stop_words", "stop_ratio", least=0.01),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
    Rule("line_length", "words_per_line", least=1.0),
    Rule("repeated_phrases", "repeat_ratio", most=0.5),
]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and their ratios.

    Columns of these names are replaced. A null or wordless text has zeros. Ratios over no
    words or lines are zero.
    """
    source = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.withColumn("_text", source).withColumn(
        "_words", F.filter(F.split("_text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    )
    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.translate("_text", SPACE, "")).cast("long"),
            "n_symbols": (F.char_length("_text") - F.char_length(F.translate("_text", SYMBOLS, ""))).cast("long"),
            "_stops": F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))),
            "_lines": F.filter(F.split("_text", "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != ""),
            "_hashes": F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))),
        }
    )
    rows = rows.withColumn("_windows", F.slice("_hashes", F.lit(1), F.greatest(F.size("_hashes") - 2, F.lit(0))))
    rows = rows.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    twice = F.filter(
        "_sorted",
        lambda w, i: F.coalesce(w["h"] == F.get("_sorted", i - 1)["h"], F.lit(False))
        | F.coalesce(w["h"] == F.get("_sorted", i + 1)["h"], F.lit(False)),
    )
    covered = F.flatten(F.transform(twice, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2)))
    rows = rows.withColumns(
        {
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.when(F.col("_sorted").isNull(), 0).otherwise(F.size(F.array_distinct(covered))).cast("long"),
            "_n_lines": F.size("_lines"),
        }
    )
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    rows = rows.withColumns(
        {
            "word_length": ratio("word_chars", "n_words"),
            "symbol_ratio": ratio("n_symbols", "n_words"),
            "stop_ratio": ratio("_stops", "n_words"),
            "dup_line_ratio": ratio("n_dup_lines", "_n_lines"),
            "words_per_line": ratio("n_words", "_n_lines"),
            "repeat_ratio": ratio("n_repeat_words", "n_words"),
        }
    )
    return rows.drop("_text", "_words", "_stops", "_lines", "_hashes", "_windows", "_sorted", "_n_lines")


def verdict(rules: list[Rule] = RULES) -> Column:
    """The rules as one condition on the columns of ``measured``."""
    kept = F.lit(True)
    for rule in rules:
        if rule.least is not None:
            kept &= F.col(rule.measure) >= F.lit(rule.least)
        if rule.most is not None:
            kept &= F.col(rule.measure) <= F.lit(rule.most)
    return kept


def quality_rules(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the ratios of each row of ``docs`` (doc_id, text).

    ``base_failed``: fewer than 50 words, or more than half of them in three-word windows that
    recur in the text. ``kept``: not failed, and within all of ``rules``.
    """
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = measured(docs.select("doc_id", "text")).withColumn("base_failed", base_failed)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & verdict(rules)).alias("kept"),
        "word_length", "symbol_ratio", "stop_ratio", "dup_line_ratio", "words_per_line", "repeat_ratio",
    )
