"""Running totals within groups of any size, through permuted blocks of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from conceptree.session import materialize


def group_key(*columns: str) -> Column:
    """One text per distinct combination of values, each behind its length; null is a value of its own."""

    def marked(column: str) -> Column:
        text = F.col(column).cast("string")
        return F.when(text.isNull(), F.lit("n")).otherwise(F.concat(F.char_length(text).cast("string"), F.lit(":"), text))

    return F.concat_ws("", *[marked(c) for c in columns])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, behind as many underscores as it takes for ``df`` not to have it, in upper or lower case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def running_totals(
    df: DataFrame, group: str, key: list[str], amount: str, seed: int, per_block: int, rows_per_block: int = 16384
) -> DataFrame:
    """Add ``block`` and ``before``: what the rows ahead in the group's permutation amount to.

    Each group is dealt by hash into blocks of about ``per_block`` amount or ``rows_per_block``
    rows, blocks follow each other by number, and a block's rows by hash. Only block totals
    are summed along a group, so a hot group is as parallel as the others. ``group`` must not be
    null, ``key`` identifies a row within it, and ``df`` must give the same rows each time.
    """
    totals = df.groupBy(group).agg(F.sum(amount).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    blocks = F.greatest(F.ceil(F.col("_sum") / per_block), F.ceil(F.col("_rows") / rows_per_block), F.lit(1))
    totals = materialize(totals.select(group, blocks.cast("int").alias("_blocks")), "group_blocks")
    place = F.xxhash64(F.lit(seed), F.col(group), *key)
    dealt = (
        df.join(totals, group)
        .withColumn("_place", place)
        .withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "_place"), F.col("_blocks")).cast("int"))
        .drop("_blocks")
    )
    ahead = W.partitionBy(group).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = materialize(
        dealt.groupBy(group, "block")
        .agg(F.sum(amount).alias("_held"))
        .select(group, "block", F.coalesce(F.sum("_held").over(ahead), F.lit(0)).alias("_offset")),
        "block_offsets",
    )
    within = W.partitionBy(group, "block").orderBy("_place", *key).rowsBetween(W.unboundedPreceding, -1)
    return (
        dealt.withColumn("_within", F.coalesce(F.sum(amount).over(within), F.lit(0)))
        .join(offsets, [group, "block"])
        .select(*df.columns, "block", (F.col("_offset") + F.col("_within")).cast("long").alias("before"))
    )
