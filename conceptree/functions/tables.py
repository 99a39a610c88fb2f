"""Table changes as DataFrame transforms: nothing is updated in place."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from conceptree.session import new_table_path


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def restrict(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` occurs in ``keys.key``."""
    return df.join(keys.select(F.col(key).alias(column)), column, "left_semi").select(*df.columns)


def exclude(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` does not occur in ``keys.key``; nulls stay."""
    return df.join(keys.select(F.col(key).alias(column)), column, "left_anti").select(*df.columns)


def flag(df: DataFrame, column: str, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Add ``name``: does ``column`` occur in ``keys.key``?"""
    marks = keys.select(F.col(key).alias(column)).distinct().withColumn("_mark", F.lit(True))
    kept = [c for c in df.columns if c != name]
    return df.join(marks, column, "left").select(*kept, F.col("_mark").isNotNull().alias(name))


def append_absent(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` plus the rows of ``new`` whose keys it lacks."""
    absent = new.join(target.select(*keys), keys, "left_anti").select(*new.columns)
    return target.unionByName(absent, allowMissingColumns=True)


def update_from(
    df: DataFrame,
    on: str,
    source: DataFrame,
    key: str,
    value: str,
    target: str,
    only: Column | None = None,
) -> DataFrame:
    """Set ``target`` from the matching row of ``source``, where ``only`` holds.

    Several matches give the smallest value. Rows that cannot match keep out of the join,
    so that their null keys do not gather in one task.
    """
    source = (
        source.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(value).alias("_value"))
    )
    wanted = F.col(on).isNotNull() & (F.lit(True) if only is None else F.coalesce(only, F.lit(False)))
    kind = df.schema[target].dataType
    changed = (
        df.where(wanted)
        .join(source, F.col(on) == F.col("_key"), "left")
        .withColumn(target, F.when(F.col("_key").isNotNull(), F.col("_value").cast(kind)).otherwise(F.col(target)))
        .select(*df.columns)
    )
    return changed.unionByName(df.where(~wanted))


def iterate(
    start: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    label: str,
    max_steps: int | None = None,
    once: bool = False,
    loop: tuple[str, str] | None = None,
) -> DataFrame:
    """Apply ``step`` to its own result until nothing comes out.

    Each result is one partition ``step=k`` (0 for ``start``) of a table in the shared
    folder, and the whole table is returned. Only the newest result is joined again. With
    ``once``, rows that came out before are left out, so cycles end too. Otherwise ``loop``
    names two columns that are equal only in a row of a cycle, which is an error that tells
    its value. ``max_steps`` is a bound to stop at, not an error.
    """
    spark = start.sparkSession
    folder = new_table_path(spark, label)
    reader = spark.read.option("basePath", folder)
    schema = StructType([*start.schema.fields, StructField("step", IntegerType())])
    frontier, k = start, 0
    closed = F.max(F.when(F.col(loop[0]) == F.col(loop[1]), F.col(loop[0]))) if loop else F.lit(None)
    while True:
        path = f"{folder}/step={k}"
        frontier.write.parquet(path)
        frontier = spark.read.schema(start.schema).parquet(path)
        count, at = frontier.agg(F.count(F.lit(1)), closed).first()
        if at is not None:
            raise ValueError(f"{label}: the hierarchy has a cycle through {at}")
        if not count or k == max_steps:
            break
        frontier, k = step(frontier), k + 1
        if once:
            before = reader.schema(schema).parquet(folder).select(*start.columns)
            frontier = frontier.distinct().join(before, start.columns, "left_anti")
    return reader.schema(schema).parquet(folder)


def doubled(links: DataFrame, label: str) -> DataFrame:
    """Distinct (above, below) of all paths over ``links`` (above, below), whatever their length.

    Round k adds the pairs whose shortest path has over 2**(k-1) and up to 2**k links: the newest
    pairs, continued by all pairs so far. Pairs that came out before are left out, so cycles end.
    """
    spark = links.sparkSession
    folder = new_table_path(spark, label)
    names = ["above", "below"]
    schema = links.select(*names).schema
    whole = spark.read.option("basePath", folder).schema(StructType([*schema.fields, StructField("step", IntegerType())]))
    newest, k = links.select(*names).where("above is not null and below is not null").distinct(), 0
    while True:
        path = f"{folder}/step={k}"
        newest.write.parquet(path)
        newest = spark.read.schema(schema).parquet(path)
        known = whole.parquet(folder).select(*names)
        if newest.isEmpty():
            return known
        on = known.select(F.col("above").alias("middle"), F.col("below").alias("end"))
        longer = newest.join(on, F.col("below") == F.col("middle")).select("above", F.col("end").alias("below")).distinct()
        newest, k = longer.join(known, names, "left_anti"), k + 1
