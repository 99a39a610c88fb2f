import pytest
from conftest import got
from pyspark.sql import functions as F

from conceptree.operators import labs
from conceptree.operators.registry import dataset_registry
from conceptree.schema import CONCEPT
from conceptree.session import materialize

LEVELS = "parent_concept_id int, concept_id int, concept_name string"
PEOPLE = "concept_id int, value_id int, person_id long, has_number boolean"
ANCESTORS = "ancestor_concept_id int, descendant_concept_id int"


@pytest.fixture(scope="module")
def registry(spark):
    return dataset_registry(spark, "omop")


@pytest.fixture(scope="module")
def candidates(make, registry):
    """1 over 2 and 3; 2 over 20 and 21; 3 over 21 and 30; 4 without any tip."""

    def build(names=None):
        edges = [(None, 1), (1, 2), (1, 3), (2, 20), (2, 21), (3, 21), (3, 30), (1, 4), (4, 40)]
        levels = make(LEVELS, *[(p, c, (names or {}).get(c, f"n{c}")) for p, c in edges])
        return materialize(labs.lab_candidates(levels, registry), "candidates")

    return build


def ids(rows):
    return got(rows, "parent_concept_id", "concept_id")


def test_candidate_rows(candidates):
    rows = got(candidates({2: "Set with Reset"}).where("concept_id in (1, 2, 20)"),
               "external_id", "external_parent_id", "is_parent", "is_root", "sql_set_id", "sql_set_where")
    assert rows[0][:5] == ("lab:1", None, True, True, 7)
    assert rows[1][:5] == ("lab:2", "lab:1", True, False, 7)
    assert rows[1][5].startswith("/*   Re */ EXISTS (SELECT 1 ") and rows[1][5].endswith("= 2)")
    assert rows[2] == ("lab:20", "lab:2", False, False, 7, "/* n20 */ @.measurement_concept_id = 20")


def test_unmeasured_tips_go(candidates, make):
    people = make(PEOPLE, (20, None, 1, True), (4, None, 1, True))
    assert ids(labs.prune_leaves(candidates(), people).where("not is_parent")) == [(2, 20)]


def test_parents_go_in_one_pass(candidates, make):
    """4 has data of its own but no tip; 3 has no data at all."""
    people = make(PEOPLE, (20, None, 1, True), (4, None, 1, True))
    above = make(ANCESTORS, (1, 20), (2, 20), (4, 4), (1, 4))
    rows = labs.prune_parents(labs.prune_leaves(candidates(), people), people, above)
    assert ids(rows) == [(1, 2), (2, 20), (None, 1)]


def test_one_pass_leaves_what_a_second_would_take(make, registry):
    levels = make(LEVELS, (None, 1, "a"), (1, 2, "b"), (2, 3, "c"), (3, 4, "d"))
    people = make(PEOPLE, (3, None, 1, True))
    above = make(ANCESTORS, (1, 3), (2, 3), (3, 3))
    kept = labs.prune_leaves(labs.lab_candidates(levels, registry), people)
    assert ids(labs.prune_parents(kept, people, above)) == [(1, 2), (None, 1)]
    assert ids(labs.prune_parents(kept, people, above, to_fixpoint=True)) == []


@pytest.fixture(scope="module")
def counted(candidates, make):
    people = make(
        PEOPLE, (20, None, 1, True), (20, 7, 1, False), (20, 7, 2, False), (21, 7, 3, False), (30, 8, 3, False),
        (30, 9, 4, False), (30, 8, 5, False), (2, None, 9, True),
    )
    above = make(ANCESTORS, (1, 20), (1, 21), (1, 30), (2, 20), (2, 21), (2, 2), (3, 21), (3, 30), (20, 20))
    kept = materialize(labs.prune_parents(labs.prune_leaves(candidates(), people), people, above), "kept")
    return materialize(labs.closure_counts(kept, people, above), "counted"), people


def test_counts(counted):
    rows = {r.concept_id: (r.ui_display_patient_count, r.is_numeric) for r in counted[0].collect()}
    assert rows == {1: (5, False), 2: (4, False), 3: (3, False), 20: (2, True), 21: (1, False), 30: (3, False)}


def test_a_concept_stays_under_its_largest_parent(counted):
    assert (2, 21) in ids(labs.single_parent_choice(counted[0])) and (3, 21) not in ids(labs.single_parent_choice(counted[0]))


def test_tie_goes_to_the_smaller_parent(counted):
    level = counted[0].withColumn("ui_display_patient_count", F.lit(1))
    assert [r for r in ids(labs.single_parent_choice(level)) if r[1] == 21] == [(2, 21)]


def test_result_concepts(counted, make):
    concept = make("concept_id int, concept_name string", (7, "Positive"), (8, "Negative"))
    rows = labs.value_concepts(labs.lab_name_cleanup(labs.single_parent_choice(counted[0])), counted[1], concept)
    assert rows.columns == CONCEPT.names
    values = got(rows.where("external_id rlike ':.*:'"), "external_id", "external_parent_id", "ui_display_name",
                 "ui_display_text", "ui_display_patient_count", "is_numeric", "is_parent")
    assert values == [
        ("lab:20:7", "lab:20", "Positive", "Had laboratory test for n20 that was Positive", 2, True, False),
        ("lab:21:7", "lab:21", "Positive", "Had laboratory test for n21 that was Positive", 1, False, False),
        ("lab:30:8", "lab:30", "Negative", "Had laboratory test for n30 that was Negative", 2, False, False),
    ]
    assert rows.where("external_id = 'lab:20'").first().is_parent
    where = rows.where("external_id = 'lab:20:7'").first().sql_set_where
    assert where == "/* n20 */ @.measurement_concept_id = 20 AND @.value_as_concept_id = 7"


def test_names(candidates):
    names = {
        1: "Laboratory", 2: "Blood", 3: "Serum | Blood", 4: "Blood", 20: "Blood | glucose", 21: "Blood", 30: "Serum | Blood | XXX | x",
        40: "Blood .Ratio",
    }
    rows = candidates(names).where("not (concept_id = 21 and parent_concept_id = 3)")
    rows = rows.withColumn("is_numeric", F.col("concept_id") == 20)
    found = {r.concept_id: r for r in labs.lab_name_cleanup(rows).collect()}
    assert {k: r.ui_display_name for k, r in found.items()} == {
        1: "Labs", 2: "Blood", 3: "Serum | Blood", 4: "Blood", 20: "Glucose", 21: "", 30: "X", 40: "Ratio",
    } | {30: "x"}
    assert (found[20].ui_numeric_default_text, found[20].sql_field_numeric) == ("of any result", "@.value_as_number")
    assert found[21].sql_field_numeric is None and found[1].ui_display_text == "Had a laboratory test performed"


def test_facts_are_combined_by_test_result_and_person(make):
    facts = make(
        "measurement_concept_id int, value_as_concept_id int, person_id long, value_as_number double",
        (1, None, 1, None), (1, None, 1, 2.0), (1, 5, 1, None), (1, None, 2, None),
    )
    assert got(labs.measured_people(facts)) == [(1, 5, 1, False), (1, None, 1, True), (1, None, 2, False)]
