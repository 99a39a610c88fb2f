"""The laboratory hierarchy: pruned to what was measured, counted, renamed, with results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from conceptree import fixed_values as fixed
from conceptree.functions.bitmaps import people_above, renewed, set_sizes
from conceptree.functions.tables import flag, restrict
from conceptree.functions.text import comment, contains_word, drop_first, first_upper, remove_word
from conceptree.operators.registry import sql_set
from conceptree.schema import CONCEPT, as_catalog, predicate
from conceptree.session import materialize

_SOURCE = ["concept_id", "concept_name", "parent_concept_id"]


def measured_people(measurement: DataFrame) -> DataFrame:
    """Distinct (concept_id, value_id, person_id) with `has_number`: was any value numeric?

    The one pass over the facts that pruning, counts and result concepts share. Rows are
    combined before the shuffle, and the shuffle key holds all three, so neither a hot
    test nor a hot person gathers in one task.
    """
    return measurement.groupBy(
        F.col("measurement_concept_id").alias("concept_id"),
        F.col("value_as_concept_id").alias("value_id"),
        "person_id",
    ).agg(F.bool_or(F.col("value_as_number").isNotNull()).alias("has_number"))


def lab_candidates(levels: DataFrame, registry: DataFrame, as_of=None) -> DataFrame:
    """A catalog row per (parent, child), plus the columns concept_id, concept_name, parent_concept_id."""
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of)
    pairs = levels.select(*_SOURCE).distinct()
    pairs = flag(pairs, "concept_id", levels.where("parent_concept_id is not null"), "parent_concept_id", "is_parent")

    code, is_parent = F.col("concept_id").cast("string"), F.col("is_parent")
    parent_test = F.concat(F.lit(fixed.LAB_PARENT_WHERE), code, F.lit(")"))
    own_test = F.concat(F.lit("@.measurement_concept_id = "), code)
    plain_name = remove_word(remove_word(F.col("concept_name"), "WITH"), "SET")
    rows = pairs.withColumns(
        {
            "external_id": F.concat(F.lit("lab:"), code),
            "external_parent_id": F.concat(F.lit("lab:"), F.col("parent_concept_id").cast("string")),
            "is_patient_count_auto_calculated": F.lit(True),
            "is_numeric": F.lit(False),
            "is_root": F.col("parent_concept_id").isNull(),
            "is_specializable": F.lit(False),
            "sql_set_id": sql_set(registry, fixed.LAB_DATASET),
            "sql_set_where": F.concat(comment(plain_name), F.when(is_parent, parent_test).otherwise(own_test)),
            "ui_display_name": F.col("concept_name"),
            "ui_display_text": F.concat(F.lit("Had laboratory test for "), "concept_name"),
            "ui_display_patient_count": F.lit(0),
            "add_date_time": stamp,
            "content_last_update_date_time": stamp,
            "predicate": predicate(
                fixed.LAB_DATASET,
                F.when(is_parent, "descendant_of").otherwise("eq"),
                "measurement_concept_id",
                code,
            ),
        }
    )
    catalog = {f.name: (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType) for f in CONCEPT}
    return rows.select(*_SOURCE, *[c.alias(n) for n, c in catalog.items()])


def prune_leaves(candidates: DataFrame, measured: DataFrame) -> DataFrame:
    """Without the tips that were never measured (``measured`` has a column concept_id)."""
    tips = restrict(candidates.where("not is_parent"), "concept_id", measured, "concept_id")
    return candidates.where("is_parent").unionByName(tips)


def prune_parents(
    candidates: DataFrame, measured: DataFrame, ancestors: DataFrame, to_fixpoint: bool = False
) -> DataFrame:
    """Without the parents that have no measured descendant, then without those left childless.

    The second step runs once, so a parent that loses its last child by it stays;
    ``to_fixpoint`` repeats it until nothing changes.
    """
    codes = measured.select(F.col("concept_id").alias("descendant_concept_id"))
    with_data = ancestors.join(codes, "descendant_concept_id", "left_semi").select("ancestor_concept_id").distinct()
    parents = restrict(candidates.where("is_parent"), "concept_id", with_data, "ancestor_concept_id")
    kept = candidates.where("not is_parent").unionByName(parents)
    while True:
        children = kept.where("parent_concept_id is not null").select("parent_concept_id").distinct()
        parents = restrict(kept.where("is_parent"), "concept_id", children, "parent_concept_id")
        fewer = kept.where("not is_parent").unionByName(parents)
        if not to_fixpoint:
            return fewer
        before, kept = kept, materialize(fewer, "pruned")
        if before.count() == kept.count():
            return kept


def closure_counts(candidates: DataFrame, people: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Set the patient counts, and `is_numeric` where a tip has a numeric value.

    A tip counts its own patients, a parent those of all its descendants in ``ancestors``
    (itself too, if the table says so).
    """
    by_tip = people.groupBy("concept_id").agg(
        F.countDistinct("person_id").alias("own_count"), F.bool_or("has_number").alias("own_number")
    )
    parents = candidates.where("is_parent").select(F.col("concept_id").alias("ancestor_concept_id")).distinct()
    links = ancestors.select("ancestor_concept_id", "descendant_concept_id").join(
        parents, "ancestor_concept_id", "left_semi"
    )
    sets = people_above(people, "concept_id", "person_id", links, "descendant_concept_id", "ancestor_concept_id")
    below = set_sizes(sets, "ancestor_concept_id", "below_count").withColumnRenamed("ancestor_concept_id", "concept_id")
    is_parent = F.col("is_parent")
    return (
        candidates.join(by_tip, "concept_id", "left")
        .join(below, "concept_id", "left")
        .withColumn(
            "ui_display_patient_count",
            F.coalesce(F.when(is_parent, F.col("below_count")).otherwise(F.col("own_count")), F.lit(0)),
        )
        .withColumn("is_numeric", F.coalesce(~is_parent & F.col("own_number"), F.lit(False)))
        .select(*candidates.columns)
    )


def parent_sets(people: DataFrame, ancestors: DataFrame) -> DataFrame:
    """(concept_id, bucket, people) of every concept in ``ancestors``, to be stored and renewed."""
    links = ancestors.select("ancestor_concept_id", "descendant_concept_id")
    sets = people_above(people, "concept_id", "person_id", links, "descendant_concept_id", "ancestor_concept_id")
    return sets.withColumnRenamed("ancestor_concept_id", "concept_id")


def renewed_counts(counts: DataFrame, sets: DataFrame, added: DataFrame, ancestors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``counts`` (concept_id, patient_count) and ``sets`` of ``parent_sets`` after more people were measured.

    ``added`` (concept_id, person_id) may repeat what is known. Only concepts at or above an added
    one are counted again, and of those only the buckets that somebody was added to: the count
    grows by what these buckets hold more than before.
    """
    key = ["concept_id", "bucket"]
    changed = materialize(renewed(sets, parent_sets(added, ancestors), "concept_id"), "renewed_sets")
    grown = changed.groupBy("concept_id").agg(F.sum(F.bit_count("people") - F.bit_count("before")).alias("n"))
    after = counts.join(grown, "concept_id", "full").select(
        "concept_id", (F.coalesce("patient_count", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("patient_count")
    )
    kept = sets.join(changed.select(*key), key, "left_anti").select(*sets.columns)
    return after, kept.unionByName(changed.select(*sets.columns))


def single_parent_choice(candidates: DataFrame) -> DataFrame:
    """One row per concept: under the parent with the most patients, the smaller id on a tie."""
    counts = candidates.groupBy(F.col("concept_id").alias("parent_concept_id")).agg(
        F.max("ui_display_patient_count").alias("parent_count")
    )
    chosen = (
        candidates.where("parent_concept_id is not null")
        .select("concept_id", "parent_concept_id")
        .join(counts, "parent_concept_id", "left")
        .groupBy("concept_id")
        .agg(
            F.max_by(
                "parent_concept_id", F.struct(F.coalesce("parent_count", F.lit(-1)), -F.col("parent_concept_id"))
            ).alias("parent_concept_id")
        )
    )
    kept = candidates.join(chosen, ["concept_id", "parent_concept_id"], "left_semi").select(*candidates.columns)
    return kept.unionByName(candidates.where("parent_concept_id is null"))


def lab_name_cleanup(candidates: DataFrame) -> DataFrame:
    """Numeric texts, the root's name, and shorter display names."""
    is_root, is_numeric, name = F.col("is_root"), F.col("is_numeric"), F.col("ui_display_name")
    rows = candidates.withColumns(
        {
            "ui_numeric_default_text": F.when(is_numeric, "of any result").otherwise(F.col("ui_numeric_default_text")),
            "sql_field_numeric": F.when(is_numeric, "@.value_as_number").otherwise(F.col("sql_field_numeric")),
            "ui_display_name": F.when(is_root, "Labs").otherwise(name),
            "ui_display_text": F.when(is_root, "Had a laboratory test performed").otherwise(F.col("ui_display_text")),
        }
    )
    # Every child sees its parent's name as it was before any child was renamed.
    above = rows.groupBy(F.col("external_id").alias("external_parent_id")).agg(
        F.min("ui_display_name").alias("above_name")
    )
    linked = F.col("external_parent_id").isNotNull()
    shortened = (
        rows.where(linked)
        .join(above, "external_parent_id", "left")
        .withColumn(
            "ui_display_name",
            F.when(F.col("above_name").isNull(), name).otherwise(F.trim(F.replace(name, F.col("above_name"), F.lit("")))),
        )
        .select(*rows.columns)
        .unionByName(rows.where(~linked))
    )
    no_bar = F.when(name.startswith("| "), F.trim(drop_first(name, 2))).otherwise(name)
    no_mark = F.when(name.startswith(".") | name.startswith("/"), F.trim(drop_first(name, 1))).otherwise(name)
    no_filler = F.when(contains_word(name, "XXX"), F.trim(remove_word(name, "XXX |"))).otherwise(name)
    for rule in (no_bar, no_mark, first_upper(name), no_filler):
        shortened = shortened.withColumn("ui_display_name", rule)
    return shortened


def value_concepts(candidates: DataFrame, people: DataFrame, concept: DataFrame) -> DataFrame:
    """The catalog rows plus one per tip and coded result, with its distinct patients.

    The facts are counted by (test, result) first, and the counts meet the names of the results that
    occur before they meet the rows: results are few, and whole rows would gather in one task for each.
    What is found is stored, so that the facts are read once for the rows and the parent flags.
    """
    counts = materialize(
        people.where("value_id is not null")
        .groupBy("concept_id", "value_id")
        .agg(F.count("person_id").alias("patients")),
        "result_counts",
    )
    names = concept.select(F.col("concept_id").alias("value_id"), F.col("concept_name").alias("value_name"))
    names = materialize(restrict(names, "value_id", counts.select("value_id").distinct(), "value_id"), "result_names")
    tips = candidates.where("not is_parent")
    found = materialize(tips.join(counts.join(names, "value_id"), "concept_id"), "results")

    value = F.col("value_id").cast("string")
    p = F.col("predicate")
    rows = as_catalog(
        found,
        external_id=F.concat("external_id", F.lit(":"), value),
        external_parent_id=F.col("external_id"),
        is_parent=False,
        sql_set_where=F.concat("sql_set_where", F.lit(" AND @.value_as_concept_id = "), value),
        ui_display_name=F.col("value_name"),
        ui_display_text=F.concat("ui_display_text", F.lit(" that was "), "value_name"),
        ui_display_patient_count=F.col("patients"),
        predicate=p.withField("value_field", F.lit("value_as_concept_id")).withField("value", value),
    )
    tested = flag(candidates, "concept_id", found, "concept_id", "_has_values")
    parents = as_catalog(tested, is_parent=F.col("is_parent") | F.col("_has_values"))
    return parents.unionByName(rows)
