"""Numbering rows at scale.

``row_number()`` over a whole table sorts it in one task, and over a key it sorts the
largest group in one task. Here the rows are range-partitioned instead, so that no task
holds more than its share, and each partition's numbers start where the last one ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from conceptree.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition in the high bits, row in the low 33


def number_rows(df: DataFrame, order: list[str], name: str = "id", start: int = 1) -> DataFrame:
    """Add consecutive numbers ``start``, ``start + 1``, ... in the order of ``order``.

    ``order`` should identify a row; equal rows stay in one partition.
    """
    # Written once: the partition borders come from a sample, so they must not be redrawn.
    # Adaptive execution may merge neighbouring partitions, which keeps their order.
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _ROW_BITS))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_at"),
        "numbered",
    )
    # One row per partition, whatever the size of the data: bounded, so safe to broadcast.
    before = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.col("_row") + F.lit(start)).cast("long").alias(name)
    )


def number_within(df: DataFrame, key: str, order: list[str], name: str = "rank") -> DataFrame:
    """Number the rows of each ``key`` from 1 in the order of ``order``.

    Only the rows of keys that repeat are sorted. A key's rows are consecutive in their
    numbering, so its first number is enough; a hot key is split by the adaptive skew join.
    """
    rows = materialize(
        df.join(df.groupBy(key).count().where("count > 1").select(key, F.lit(True).alias("_repeats")), key, "left"), "repeats"
    )
    first = rows.where("_repeats is null").select(*df.columns, F.lit(1).cast("long").alias(name))
    numbered = number_rows(rows.where("_repeats").drop("_repeats"), [key, *order], "_g")
    starts = numbered.groupBy(key).agg(F.min("_g").alias("_first"))
    again = numbered.join(starts, key).select(*df.columns, (F.col("_g") - F.col("_first") + 1).alias(name))
    return first.unionByName(again)
