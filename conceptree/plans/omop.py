"""The OMOP catalog: demographics, encounters, vitals and labs with patient counts."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from conceptree import fixed_values as fixed
from conceptree.functions.numbering import number_rows
from conceptree.functions.tables import exclude, union_all
from conceptree.operators import labs
from conceptree.operators.hierarchy import (
    backfill_ancestors,
    hierarchy_levels,
    parent_link,
    root_assign,
    transitive_closure,
)
from conceptree.operators.people import demographic_concepts, visit_concepts, vital_concepts
from conceptree.schema import CONCEPT, conform
from conceptree.session import at_once, materialize


def with_links(new: DataFrame, order: list[str], existing: DataFrame | None = None) -> DataFrame:
    """``existing`` plus ``new``: ids for the new rows in the order of ``order``, then parents and roots.

    Parents and roots are found on the few columns that name them and meet the whole rows once. A row is
    known by its new id, or by its place in a copy of ``existing``, whose ids may repeat.
    """
    last = existing.agg({"id": "max"}).first()[0] if existing is not None else None
    numbered = conform(number_rows(new.drop("id"), order, start=(last or 0) + 1), CONCEPT)
    rows = numbered.select("*", F.lit(True).alias("_new"), F.col("id").alias("_row"))
    if existing is not None:
        placed = existing.select("*", F.lit(False).alias("_new"), F.monotonically_increasing_id().alias("_row"))
        rows = materialize(placed, "existing").unionByName(rows)
    links = rows.select("_new", "_row", "id", "parent_id", "root_id", "external_id", "external_parent_id", "is_root")
    found = root_assign(materialize(parent_link(links), "linked")).select("_new", "_row", "parent_id", "root_id")
    return rows.drop("parent_id", "root_id").join(found, ["_new", "_row"]).select(*CONCEPT.names)


class LabBuild:
    """The lab build stage by stage. A stage that others read again is a stored table."""

    def __init__(self, tables, registry: DataFrame, root_id: int = fixed.LAB_ROOT_CONCEPT_ID, as_of=None):
        self.tables, self.registry, self.root_id, self.as_of = tables, registry, root_id, as_of

    @cached_property
    def levels(self) -> DataFrame:
        return materialize(
            hierarchy_levels(self.tables["concept"], self.tables["concept_relationship"], self.root_id), "levels"
        )

    @cached_property
    def closure(self) -> DataFrame:
        return materialize(transitive_closure(self.levels), "closure")

    @cached_property
    def ancestors(self) -> DataFrame:
        return backfill_ancestors(self.tables["concept_ancestor"], self.closure)

    @cached_property
    def people(self) -> DataFrame:
        return materialize(labs.measured_people(self.tables["measurement"]), "people")

    @cached_property
    def measured(self) -> DataFrame:
        return materialize(self.people.select("concept_id").distinct(), "measured")

    @cached_property
    def candidates(self) -> DataFrame:
        return materialize(labs.lab_candidates(self.levels, self.registry, self.as_of), "candidates")

    @cached_property
    def measured_leaves(self) -> DataFrame:
        return labs.prune_leaves(self.candidates, self.measured)

    @cached_property
    def pruned(self) -> DataFrame:
        # The facts and the hierarchy meet here first.
        at_once(self.registry.sparkSession, lambda: self.measured, lambda: (self.candidates, self.ancestors))
        return materialize(labs.prune_parents(self.measured_leaves, self.measured, self.ancestors), "pruned")

    @cached_property
    def counted(self) -> DataFrame:
        return materialize(labs.closure_counts(self.pruned, self.people, self.ancestors), "counted")

    @cached_property
    def single_parent(self) -> DataFrame:
        return labs.single_parent_choice(self.counted)

    @cached_property
    def named(self) -> DataFrame:
        return materialize(labs.lab_name_cleanup(self.single_parent), "named")

    @cached_property
    def concepts(self) -> DataFrame:
        """Pruned, counted and renamed lab tests with their coded results."""
        return labs.value_concepts(self.named, self.people, self.tables["concept"])


def build_catalog_omop(
    tables, registry: DataFrame, lab_root_id: int = fixed.LAB_ROOT_CONCEPT_ID, as_of=None, existing: DataFrame | None = None
) -> DataFrame:
    """The whole catalog; ``tables[name]`` gives the clinical tables.

    The rows of an ``existing`` catalog keep their ids, and concepts whose external id it lacks are added.
    """
    concept = tables["concept"]
    parts = at_once(
        registry.sparkSession,
        lambda: LabBuild(tables, registry, lab_root_id, as_of).concepts,
        lambda: demographic_concepts(tables["person"], concept, tables["death"], registry),
        lambda: visit_concepts(tables["visit_occurrence"], concept, registry),
        lambda: vital_concepts(tables["measurement"], concept, registry),
    )
    new = union_all(*parts)
    if existing is not None:
        new = exclude(materialize(new, "new"), "external_id", existing, "external_id")
    return with_links(new, ["external_id"], existing)
