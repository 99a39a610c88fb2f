"""Concepts found in the data: demographics, visit types, vital signs, with patient counts.

Facts are counted by code before names are joined, so a code that covers half of all
people never meets the concept table as a hot join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from conceptree import fixed_values as fixed
from conceptree.functions.text import comment
from conceptree.operators.registry import FIXED_ROW, fixed_rows, sql_set, with_sql_set
from conceptree.schema import as_catalog, predicate
from conceptree.session import materialize


def _named(counts: DataFrame, concept: DataFrame) -> DataFrame:
    """(concept_id, patients) with the concept's name; unknown codes vanish."""
    return counts.join(concept.select("concept_id", "concept_name"), "concept_id")


def _fixed_part(rows: list[tuple], tallies: DataFrame, registry: DataFrame) -> DataFrame:
    frame = fixed_rows(tallies.sparkSession, rows).join(tallies, "external_id", "left")
    return as_catalog(
        with_sql_set(frame, registry),
        ui_display_patient_count=F.col("patients"),
        predicate=predicate(
            F.col("dataset"), F.col("kind"), other=F.when(F.col("kind") == "not_exists", F.lit("dbo.v_death"))
        ),
    )


def _root_part(row: tuple, tally: DataFrame, registry: DataFrame) -> DataFrame:
    """A root concept made of the one row that holds its count."""
    values = dict(zip((c.split()[0] for c in FIXED_ROW.split(",")), row))
    dataset, kind = values.pop("dataset"), values.pop("kind")
    return as_catalog(
        tally,
        **values,
        sql_set_id=sql_set(registry, dataset),
        ui_display_patient_count=F.col("patients"),
        predicate=predicate(dataset, kind),
    )


def _coded_part(
    named: DataFrame,
    registry: DataFrame,
    dataset: str,
    field: Column,
    prefix: Column,
    text: Column,
    where_comment: bool = True,
    **values,
) -> DataFrame:
    """One row per code: (concept_id, concept_name, patients) as catalog rows."""
    code = F.col("concept_id").cast("string")
    test = F.concat(F.lit("@."), field, F.lit(" = "), code)
    where = F.concat(comment(F.col("concept_name")), test) if where_comment else test
    return as_catalog(
        named,
        external_id=F.concat(prefix, F.lit(":"), code),
        external_parent_id=prefix,
        is_root=False,
        sql_set_id=sql_set(registry, dataset),
        sql_set_where=where,
        ui_display_name=F.col("concept_name"),
        ui_display_text=text,
        ui_display_patient_count=F.col("patients"),
        predicate=predicate(dataset, "eq", field, code),
        **values,
    )


def demographic_concepts(person: DataFrame, concept: DataFrame, death: DataFrame, registry: DataFrame) -> DataFrame:
    """Gender, ethnicity, race, age and vital status."""
    dead = death.select("person_id").distinct().withColumn("dead", F.lit(True))
    # One pass gives the people, the living and the deceased.
    totals = (
        person.select("person_id")
        .join(dead, "person_id", "left")
        .agg(
            F.count(F.lit(1)).alias("people"),
            F.count_if(F.col("dead").isNull()).alias("living"),
            F.count("dead").alias("deceased"),
        )
        .select(
            F.explode(
                F.create_map(
                    F.lit("demographics"), "people",
                    F.lit("demographics:age"), "people",
                    F.lit("demographics:vital"), "people",
                    F.lit("demographics:vital:living"), "living",
                    F.lit("demographics:vital:deceased"), "deceased",
                )
            ).alias("external_id", "patients")
        )
    )
    # And one pass the people of every gender, ethnicity and race code.
    codes = F.create_map(
        F.lit("gender"), "gender_concept_id",
        F.lit("ethnicity"), "ethnicity_concept_id",
        F.lit("race"), "race_concept_id",
    )
    counts = materialize(
        person.select("person_id", F.explode(codes).alias("kind", "concept_id"))
        .where("concept_id <> 0")
        .groupBy("kind", "concept_id")
        .agg(F.countDistinct("person_id").alias("patients")),
        "counts",
    )
    named = _named(counts, concept)
    parent = F.concat(F.lit("demographics:"), "kind")
    sums = named.groupBy(parent.alias("external_id")).agg(F.sum("patients").alias("patients"))
    coded = _coded_part(
        named,
        registry,
        "dbo.person",
        F.concat("kind", F.lit("_concept_id")),
        parent,
        F.concat(F.lit("Identify as "), "concept_name"),
        is_numeric=False,
        is_parent=False,
    )
    return _fixed_part(fixed.OMOP_DEMOGRAPHICS, totals.unionByName(sums), registry).unionByName(coded)


def _people_by_code(facts: DataFrame, code: str) -> tuple[DataFrame, DataFrame]:
    """Distinct people overall and by code.

    One scan of the facts gives both; the counts are stored, as the two filters below would
    otherwise each reach down to a scan of their own.
    """
    counts = materialize(
        facts.rollup(F.col(code).alias("concept_id")).agg(
            F.countDistinct("person_id").alias("patients"), F.grouping_id().alias("overall")
        ),
        "counts",
    )
    return counts.where("overall = 1").select("patients"), counts.where("overall = 0").drop("overall")


def visit_concepts(visit_occurrence: DataFrame, concept: DataFrame, registry: DataFrame) -> DataFrame:
    """Visit types. The root counts every visit, also those of unknown type (code 0)."""
    overall, by_code = _people_by_code(visit_occurrence.select("person_id", "visit_concept_id"), "visit_concept_id")
    root = _root_part(fixed.OMOP_VISITS_ROOT, overall, registry)
    types = _coded_part(
        _named(by_code.where("concept_id != 0"), concept),
        registry,
        "dbo.visit_occurrence",
        F.lit("visit_concept_id"),
        F.lit("visit"),
        F.concat(F.lit("Had an "), "concept_name"),
        is_numeric=False,
        is_parent=True,
    )
    return root.unionByName(types)


def vital_concepts(
    measurement: DataFrame,
    concept: DataFrame,
    registry: DataFrame,
    ids: list[int] | None = None,
) -> DataFrame:
    """Vital signs. Codes without a concept form one nameless row."""
    ids = sorted(set(ids or fixed.VITAL_CONCEPT_IDS.values()))
    # One row per listed id at the most, so broadcasting is safe.
    names = concept.where(F.col("concept_id").isin(ids)).select("concept_id", "concept_name").dropDuplicates(["concept_id"])
    facts = (
        measurement.where(F.col("measurement_concept_id").isin(ids))
        .select("person_id", "measurement_concept_id")
        .join(F.broadcast(names), F.col("measurement_concept_id") == F.col("concept_id"), "left")
    )
    overall, by_code = _people_by_code(facts, "concept_id")
    root = _root_part(fixed.OMOP_VITALS_ROOT, overall, registry)
    named = by_code.join(F.broadcast(names), "concept_id", "left").select("concept_id", "concept_name", "patients")
    signs = _coded_part(
        named,
        registry,
        "dbo.measurement",
        F.lit("measurement_concept_id"),
        F.lit("vitals"),
        F.concat(F.lit("Had "), "concept_name", F.lit(" measured")),
        where_comment=False,
        is_numeric=True,
        is_parent=False,
        sql_field_numeric="@.value_as_number",
        ui_numeric_default_text="of any result",
    )
    return root.unionByName(signs)
