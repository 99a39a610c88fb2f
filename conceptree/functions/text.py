"""Text rules of the catalog as column expressions.

Text concatenation is ``F.concat`` throughout: one null part makes the result null.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def cut(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def drop_first(text: Column, count: int) -> Column:
    """Everything after the first ``count`` characters; '' if there is nothing left."""
    return F.substr(text, F.lit(count + 1))


def remove_word(text: Column, word: str) -> Column:
    """Take out every occurrence of ``word`` in any case."""
    return F.regexp_replace(text, "(?i)" + re.escape(word), "")


def contains_word(text: Column, word: str) -> Column:
    return F.lower(text).contains(word.lower())


def first_upper(text: Column) -> Column:
    return F.concat(F.upper(cut(text, 1)), drop_first(text, 1))


def age_in_years(birth: Column, as_of: Column) -> Column:
    return (F.datediff(as_of, birth) / F.lit(365.25)).cast("double")


def comment(name: Column) -> Column:
    return F.concat(F.lit("/* "), name, F.lit(" */ "))
