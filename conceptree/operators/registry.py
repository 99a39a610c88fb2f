"""The dataset registry and the concepts that are the same at every site."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from conceptree import fixed_values as fixed
from conceptree.schema import SQL_SET, as_catalog, predicate

FIXED_ROW = """
    external_id string, external_parent_id string, is_numeric boolean, is_parent boolean,
    is_root boolean, dataset string, sql_set_where string, sql_field_numeric string,
    ui_display_name string, ui_display_text string, ui_display_units string,
    ui_numeric_default_text string, kind string
"""

_DATASETS = {"omop": fixed.OMOP_DATASETS, "pcornet": fixed.PCORNET_DATASETS}


def dataset_registry(
    spark: SparkSession,
    model: str,
    created_by: str = "conceptree",
    as_of: datetime | None = None,
    first_id: int = 1,
) -> DataFrame:
    """The datasets a concept may select from, numbered in their listed order."""
    stamp = as_of or datetime.now()
    rows = [
        (number, name, encounter, event, date, stamp, created_by, stamp, created_by)
        for number, (name, encounter, event, date) in enumerate(_DATASETS[model], first_id)
    ]
    return spark.createDataFrame(rows, SQL_SET)


def sql_set(registry: DataFrame, dataset: str) -> Column:
    """The id of one dataset, as a scalar subquery; the smallest if it is listed twice."""
    return registry.where(F.col("sql_set_from") == dataset).agg(F.min("id")).scalar()


def with_sql_set(df: DataFrame, registry: DataFrame, dataset: str = "dataset") -> DataFrame:
    """Add ``sql_set_id`` by the name in the column ``dataset``."""
    ids = registry.groupBy(F.col("sql_set_from").alias(dataset)).agg(F.min("id").alias("sql_set_id"))
    return df.join(ids, dataset, "left").select(*df.columns, "sql_set_id")


def fixed_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, FIXED_ROW)


def fixed_catalog(spark: SparkSession, registry: DataFrame) -> DataFrame:
    """PCORnet demographics and encounters: hard-coded, so equal at every site."""
    rows = fixed_rows(spark, fixed.PCORNET_FIXED)
    urn = F.concat(F.lit(fixed.URN), "external_id")
    # `@.SEX = 'F'` selects field SEX with value F
    field = F.regexp_extract("sql_set_where", r"^@\.(\w+) = '", 1)
    value = F.regexp_extract("sql_set_where", r" = '(\w+)'$", 1)
    by_value = F.col("kind") == "eq"
    return as_catalog(
        with_sql_set(rows, registry),
        external_id=urn,
        external_parent_id=F.concat(F.lit(fixed.URN), "external_parent_id"),
        universal_id=urn,
        predicate=predicate(
            F.col("dataset"),
            F.col("kind"),
            F.when(by_value, field),
            F.when(by_value, value),
            other=F.when(F.col("kind").isin("exists", "not_exists"), F.lit("dbo.DEATH")),
        ),
    )
