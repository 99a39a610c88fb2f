"""Sets of people as bitmaps: exact, mergeable, and counted without a distinct.

A set is one 64-bit bitmap for each bucket of 64 neighbouring numbers that has somebody, so it never
has more rows than people, and up to 64 times fewer where it is dense. Bitmaps of one key and bucket
are merged by OR, and a set's size is the sum of its bitmaps' sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from conceptree.functions.tables import union_all
from conceptree.session import materialize

_BITS = 6
_SPREAD = 1 << 20


def bucket_of(person: Column) -> Column:
    """The bucket of a person, whose id is an integer; null for null."""
    return F.shiftright(person.cast("long"), _BITS)


def bit_of(person: Column) -> Column:
    """The bitmap of just this person within the bucket."""
    bit = person.cast("long").bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def placed(rows: DataFrame, key: str, person: str) -> DataFrame:
    """(key, bucket, people) of each row that has a person, whose id is an integer."""
    number = F.col(person)
    return rows.where(number.isNotNull()).select(key, bucket_of(number).alias("bucket"), bit_of(number).alias("people"))


def people_above(rows: DataFrame, key: str, person: str, links: DataFrame, below: str, above: str) -> DataFrame:
    """(above, bucket, people): who has a row of a key that ``links`` puts below each ``above``.

    Keys that lie below the very same others form a group. The rows are shuffled by bucket, once for
    their group and once for their own key where that lies below itself; they become bitmaps there, and
    only a group's bitmaps are multiplied by what is above it. ``links`` may repeat.
    """
    kinds = rows.schema[key].dataType, links.schema[above].dataType
    itself = F.coalesce(F.col(below) == F.col(above), F.lit(False)) if kinds[0] == kinds[1] == links.schema[below].dataType else F.lit(False)
    lists = materialize(
        links.where(F.col(below).isNotNull())
        .groupBy(F.col(below).alias(key))
        .agg(F.sort_array(F.collect_set(F.when(~itself, F.struct(F.col(above).alias("above"))))).alias("list"), F.bool_or(itself).alias("itself")),
        "lists",
    )
    groups = materialize(
        lists.where(F.size("list") > 0).select("list").distinct().withColumn("group", F.monotonically_increasing_id()), "groups"
    )
    named = materialize(lists.join(groups, "list", "left").select(key, "group", "itself"), "grouped_keys")

    # What goes under its own key has no group: numbers of no group, spread so that they don't gather in one task.
    alone = F.struct((-1 - F.pmod("bucket", F.lit(_SPREAD))).alias("group"), F.col(key).alias("own"))
    within = F.struct("group", F.lit(None).cast(kinds[0]).alias("own"))
    to = F.array_compact(F.array(F.when(F.col("group").isNotNull(), within), F.when(F.col("itself"), alone)))
    sets = (
        placed(rows, key, person)
        .join(named, key)
        .select("bucket", "people", F.explode(to).alias("to"))
        .select("to.group", "to.own", "bucket", "people")
        .repartition("bucket")
        .groupBy("group", "own", "bucket")
        .agg(F.bit_or("people").alias("people"))
    )
    own = F.col("own") if kinds[0] == kinds[1] else F.lit(None).cast(kinds[1])
    return (
        sets.join(groups.select("group", F.explode("list").alias("_to")), "group", "left")
        .select(F.coalesce("_to.above", own).alias(above), "bucket", "people")
        .groupBy(above, "bucket")
        .agg(F.bit_or("people").alias("people"))
    )


def set_sizes(sets: DataFrame, key: str, name: str) -> DataFrame:
    return sets.groupBy(key).agg(F.sum(F.bit_count("people")).alias(name))


def merged(key: str, *sets: DataFrame) -> DataFrame:
    return union_all(*sets).groupBy(key, "bucket").agg(F.bit_or("people").alias("people"))


def renewed(sets: DataFrame, added: DataFrame, key: str) -> DataFrame:
    """(key, bucket, before, people) of what ``added`` adds to or creates; the other buckets of ``sets`` are not read on."""
    before = sets.select(key, "bucket", F.col("people").alias("before"))
    none = F.lit(0).cast("long")
    return added.join(before, [key, "bucket"], "left").select(
        key, "bucket", F.coalesce("before", none).alias("before"), F.coalesce("before", none).bitwiseOR(F.col("people")).alias("people")
    )
