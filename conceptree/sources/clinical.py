"""Input tables by name, and the view that makes deaths look like other dated facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


class ParquetTables:
    """``tables["person"]`` reads ``<folder>/person.parquet`` (file or folder)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


class CatalogTables:
    """``tables["person"]`` reads ``<namespace>.person`` from the session's catalog."""

    def __init__(self, spark: SparkSession, namespace: str):
        self.spark, self.namespace = spark, namespace

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.namespace}.{name}")


def death_view(death: DataFrame) -> DataFrame:
    """Deaths with the visit id that every dated dataset must have; it is always null."""
    return death.select(
        "person_id",
        "death_date",
        "death_datetime",
        F.lit(None).cast("long").alias("visit_occurrence_id"),
        "death_type_concept_id",
        "cause_concept_id",
        "cause_source_value",
        "cause_source_concept_id",
    )
