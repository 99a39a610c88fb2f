"""Which codes lie in which text ranges, by equi-joins only.

A ``BETWEEN`` join runs as a nested loop. Instead each code and each range end gets its
place in the sorted order; a range of places is cut into aligned blocks of 1, 2, 4, ...
codes, and a code belongs to one block of each size. Code and range then meet in exactly
one common block, so the join on (size, block) gives every match once and nothing else.
The largest block is capped, which bounds the codes that share a join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from conceptree.functions.numbering import number_rows
from conceptree.session import at_once, materialize

_TOP = 12  # blocks of up to 2**12 codes


def match_ranges(codes: DataFrame, ranges: DataFrame) -> DataFrame:
    """Distinct (lo, hi, code) with ``lo <= code <= hi`` in binary text order.

    ``codes`` has a column ``code``; ``ranges`` has ``lo`` and ``hi``.
    """
    # Stored, as both are read several times below and may come from a scan of the facts.
    spark = codes.sparkSession
    codes, ranges = at_once(
        spark,
        lambda: materialize(codes.select("code").where(F.col("code").isNotNull()).distinct(), "codes"),
        lambda: materialize(ranges.select("lo", "hi").where("lo <= hi").distinct(), "ranges"),
    )

    # A range of one code needs no order.
    equal = ranges.where("lo = hi").join(codes, F.col("lo") == F.col("code")).select("lo", "hi", "code")
    wide = ranges.where("lo < hi")
    if wide.isEmpty():
        return equal
    texts = codes.union(wide.select("lo")).union(wide.select("hi")).distinct()
    places = number_rows(texts, ["code"], "at", start=0)

    first = places.select(F.col("code").alias("lo"), F.col("at").alias("a"))
    last = places.select(F.col("code").alias("hi"), (F.col("at") + 1).alias("b"))
    spans = wide.join(first, "lo").join(last, "hi")
    return equal.unionByName(match_places(codes.join(places, "code"), spans).select("lo", "hi", "code"))


def code_groups(codes: DataFrame, ranges: DataFrame) -> DataFrame:
    """Distinct (code, first): the codes of one ``first``, the smallest of them, lie in the very same ranges.

    The ends of the ranges cut the sorted codes into stretches, at most twice as many as there are ranges;
    codes before the first and after the last end lie in none and are left out.
    """
    codes = materialize(codes.select("code").where(F.col("code").isNotNull()).distinct(), "codes")
    ranges = materialize(ranges.select("lo", "hi").where("lo <= hi").distinct(), "ranges")
    texts = codes.union(ranges.select("lo")).union(ranges.select("hi")).distinct()
    places = number_rows(texts, ["code"], "at", start=0)
    starts = ranges.join(places, F.col("lo") == F.col("code")).select("at")
    after = ranges.join(places, F.col("hi") == F.col("code")).select((F.col("at") + 1).alias("at"))
    borders = number_rows(starts.union(after).distinct(), ["at"], "stretch")
    ends = borders.select(F.col("at").alias("b"), (F.col("stretch") - 1).alias("stretch"))
    spans = materialize(borders.withColumnRenamed("at", "a").join(ends, "stretch"), "stretches")
    held = materialize(match_places(codes.join(places, "code"), spans).select("code", "stretch"), "held")
    firsts = materialize(held.groupBy("stretch").agg(F.min("code").alias("first")), "firsts")
    return held.join(firsts, "stretch").select("code", "first")


def match_places(points: DataFrame, spans: DataFrame) -> DataFrame:
    """Each row of ``points`` with each row of ``spans`` for which ``a <= at < b``.

    ``points`` has a number ``at``, ``spans`` have ``a`` and ``b``; numbers are at least 0. Other columns go along.
    """
    level = F.col("level")
    points = points.select("*", F.explode(F.sequence(F.lit(0), F.lit(_TOP))).alias("level")).withColumn(
        "block", F.call_function("shiftright", F.col("at"), level)
    )
    size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
    # Whole blocks of this size inside [a, b): numbers f .. t - 1. Those that pair up into
    # larger blocks are left to the next level; what remains is an odd one at either end.
    f, t = F.col("f"), F.col("t")
    odd_ends = F.array_compact(
        F.array(
            F.when((f < t) & (f % 2 == 1), f),
            F.when((f < t) & (t % 2 == 1), t - 1),
        )
    )
    rest = F.when(f < t, F.sequence(f, t - 1)).otherwise(F.array().cast("array<bigint>"))
    blocks = (
        spans.select("*", F.explode(F.sequence(F.lit(0), F.lit(_TOP))).alias("level"))
        .withColumn("f", F.call_function("shiftright", F.col("a") + size - 1, level))
        .withColumn("t", F.call_function("shiftright", F.col("b"), level))
        .withColumn("block", F.explode(F.when(level < _TOP, odd_ends).otherwise(rest)))
        .drop("f", "t")
    )
    # Stored, so that Spark sees when the blocks are few, and the many copies of the points stay in place.
    blocks = materialize(blocks, "blocks")
    return blocks.join(points, ["level", "block"]).drop("level", "block")
