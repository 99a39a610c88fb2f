"""Per-person demographic extracts, for patient lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from conceptree import fixed_values as fixed
from conceptree.session import materialize


def demographic_extract_omop(person: DataFrame, concept: DataFrame, location: DataFrame, death: DataFrame) -> DataFrame:
    """One row per person (and per death row).

    Three codes of each person are looked up by name. The codes in use are few but may each
    cover a large share of all people, so the concept table is cut down to them first and
    stored; its true size then decides whether the lookups are broadcast.
    """
    codes = ["gender_concept_id", "race_concept_id", "ethnicity_concept_id"]
    used = person.select(F.explode(F.array(*codes)).alias("concept_id")).distinct()
    names = materialize(concept.select("concept_id", "concept_name").join(used, "concept_id", "left_semi"), "names")

    rows = person
    for code in codes:
        label = code.removesuffix("_concept_id")
        rows = rows.join(names.select(F.col("concept_id").alias(code), F.col("concept_name").alias(label)), code, "left")
    rows = rows.join(location.select("location_id", "zip", "state"), "location_id", "left").join(
        death.select("person_id", "death_datetime", F.lit(True).alias("dead")), "person_id", "left"
    )
    absent = F.lit(None).cast("string")
    return rows.select(
        F.col("person_id").cast("string").alias("personId"),
        F.col("zip").alias("addressPostalCode"),
        F.col("state").alias("addressState"),
        F.col("birth_datetime").alias("birthDate"),
        F.col("death_datetime").alias("deceasedDateTime"),
        "ethnicity",
        "gender",
        F.col("dead").isNotNull().alias("deceasedBoolean"),
        F.coalesce(F.col("ethnicity") == fixed.HISPANIC, F.lit(False)).alias("hispanicBoolean"),
        F.lit(False).alias("marriedBoolean"),
        absent.alias("language"),
        absent.alias("maritalStatus"),
        absent.alias("mrn"),
        absent.alias("name"),
        "race",
        absent.alias("religion"),
    )


def recode(column: Column, mapping: dict[str, str]) -> Column:
    return reduce(lambda c, kv: c.when(column == kv[0], kv[1]), mapping.items(), F)


def demographic_extract_pcornet(demographic: DataFrame, death: DataFrame) -> DataFrame:
    """One row per person, with the codes spelled out and the earliest death date."""
    dates = death.groupBy("patid").agg(F.min("death_date").alias("died"), F.lit(True).alias("dead"))
    hispanic = F.coalesce(F.col("hispanic") == "Y", F.lit(False))
    unknown = F.lit("Unknown")
    return demographic.join(dates, "patid", "left").select(
        F.col("patid").alias("personId"),
        F.lit("").alias("addressPostalCode"),
        F.lit("").alias("addressState"),
        F.col("birth_date").alias("birthDate"),
        F.col("died").alias("deceasedDateTime"),
        F.when(hispanic, fixed.HISPANIC).otherwise(fixed.NOT_HISPANIC).alias("ethnicity"),
        recode(F.col("sex"), fixed.PCORNET_SEX).otherwise("Other").alias("gender"),
        unknown.alias("language"),
        unknown.alias("maritalStatus"),
        F.lit(False).alias("marriedBoolean"),
        hispanic.alias("hispanicBoolean"),
        F.col("dead").isNotNull().alias("deceasedBoolean"),
        F.lit("Unknown Unknown").alias("name"),
        unknown.alias("mrn"),
        recode(F.col("race"), fixed.PCORNET_RACE).otherwise("Other").alias("race"),
        unknown.alias("religion"),
    )
