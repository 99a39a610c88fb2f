"""Links of whole catalogs, and the small tables that whole rows meet."""

import pytest
from conftest import got
from pyspark.sql import functions as F

from conceptree.operators import labs
from conceptree.operators.registry import dataset_registry
from conceptree.plans import omop
from conceptree.schema import CONCEPT, conform
from conceptree.session import materialize
from conceptree.suite import queries

ROWS = "id long, parent_id long, root_id long, external_id string, external_parent_id string, is_root boolean"
SHOWN = ["id", "parent_id", "root_id", "external_id"]


@pytest.fixture
def stored(monkeypatch):
    """What the modules store, by label."""
    seen = {}

    def keep(df, label):
        seen[label] = materialize(df, label)
        return seen[label]

    for module in (omop, labs, queries):
        monkeypatch.setattr(module, "materialize", keep)
    return seen


def catalog(make, *rows):
    return conform(make(ROWS, *rows), CONCEPT)


def test_links_are_found_on_few_columns(make, stored):
    new = catalog(make, (None, None, None, "a", None, True), (None, None, None, "b", "a", False), (None, None, None, "c", "b", False))
    rows = omop.with_links(new, ["external_id"])
    assert rows.columns == CONCEPT.names
    assert got(rows, *SHOWN) == [(1, None, 1, "a"), (2, 1, 1, "b"), (3, 2, 1, "c")]
    assert "ui_display_name" not in stored["linked"].columns


def test_stored_rows_may_repeat_ids(make):
    """Each stored row stays once, with the parent and root it has or finds; an id may be null."""
    existing = catalog(
        make, (7, None, None, "a", None, True), (8, None, None, "b", "a", False), (8, 5, 6, "b", "a", False),
        (None, None, None, "x", "b", False),
    )
    new = catalog(make, (None, None, None, "c", "b", False), (None, None, None, "c", "b", False), (None, None, None, None, "zz", False))
    rows = omop.with_links(new, ["external_id"], existing)
    expected = [
        (7, None, 7, "a"), (8, 7, 7, "b"), (8, 5, 6, "b"), (None, 8, None, "x"),
        (9, None, None, None), (10, 8, 7, "c"), (11, 8, 7, "c"),
    ]
    assert got(rows, *SHOWN) == sorted(expected, key=repr)


def test_roots_are_stored_apart(make, stored):
    rows = catalog(make, (1, None, 1, "a", None, True), *[(i, 1, 1, f"n{i}", "a", False) for i in range(2, 9)], (9, None, None, "o", None, False))
    shown = queries.linked(rows)
    assert stored["roots"].count() == 1
    assert got(shown.where("id > 7"), "id", "parent", "root") == [(8, "a", "a"), (9, None, None)]


def test_only_names_of_found_results_meet_the_rows(spark, make, stored):
    levels = make("parent_concept_id int, concept_id int, concept_name string", (None, 1, "a"), (1, 2, "b"), (1, 3, "c"))
    people = make(
        "concept_id int, value_id int, person_id long, has_number boolean",
        (2, 7, 1, False), (2, 7, 2, False), (3, 8, 1, False), (3, 9, 1, False), (3, None, 1, False),
    )
    names = make("concept_id int, concept_name string", (7, "x"), (7, "y"), (8, "z"), (10, "no"), (None, "null"))
    rows = labs.value_concepts(labs.lab_candidates(levels, dataset_registry(spark, "omop")), people, names)
    found = rows.where(F.col("external_id").rlike(":.*:"))
    assert got(found, "external_id", "ui_display_name", "ui_display_patient_count") == [
        ("lab:2:7", "x", 2), ("lab:2:7", "y", 2), ("lab:3:8", "z", 1),
    ]
    assert got(stored["result_names"], "value_id", "value_name") == [(7, "x"), (7, "y"), (8, "z")]
