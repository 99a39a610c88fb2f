from datetime import date, datetime

import pytest
from conftest import got
from pyspark.sql import functions as F

from conceptree.session import materialize
from conceptree.operators import cohort, extracts, people
from conceptree.operators.registry import dataset_registry, fixed_catalog
from conceptree.schema import as_catalog, predicate
from conceptree.sources.clinical import ParquetTables, death_view

PERSON = "person_id long, gender_concept_id int, race_concept_id int, ethnicity_concept_id int, birth_datetime timestamp, location_id long"
BORN = datetime(2000, 1, 1)


@pytest.fixture(scope="module")
def registry(spark):
    return dataset_registry(spark, "omop")


@pytest.fixture(scope="module")
def concept(make):
    return make("concept_id int, concept_name string", (10, "F"), (11, "M"), (20, "Hispanic or Latino"), (30, "Inpatient"), (3020891, "Temp"))


@pytest.fixture(scope="module")
def person(make):
    return make(PERSON, (1, 10, 0, 20, BORN, 1), (2, 10, 0, 0, BORN, None), (3, 0, 0, 99, BORN, 7))


@pytest.fixture(scope="module")
def death(make):
    schema = ("person_id long, death_date date, death_datetime timestamp, death_type_concept_id int, cause_concept_id int,"
              " cause_source_value string, cause_source_concept_id int")
    day = date(2020, 1, 1)
    return make(schema, (1, day, None, None, None, None, None), (1, day, None, None, None, None, None), (8, day, None, None, None, None, None))


def counts(rows):
    return dict(got(rows, "external_id", "ui_display_patient_count"))


def test_demographics(person, concept, death, registry):
    found = counts(people.demographic_concepts(person, concept, death, registry))
    assert found == {
        "demographics": 3, "demographics:age": 3, "demographics:vital": 3, "demographics:vital:living": 2,
        "demographics:vital:deceased": 1, "demographics:gender": 2, "demographics:gender:10": 2,
        "demographics:ethnicity": 1, "demographics:ethnicity:20": 1, "demographics:race": None,
    }


def test_the_visit_root_counts_unknown_types(make, concept, registry):
    visits = make("person_id long, visit_concept_id int", (1, 30), (1, 30), (2, 0), (3, 77), (4, None))
    rows = people.visit_concepts(visits, concept, registry)
    assert counts(rows) == {"visit": 4, "visit:30": 1}
    assert rows.where("external_id = 'visit:30'").first().is_parent


def test_vitals_without_a_concept_share_one_nameless_row(make, concept, registry):
    facts = make("person_id long, measurement_concept_id int", (1, 3020891), (2, 3027018), (2, 3024171), (3, 3024171), (9, 5))
    rows = people.vital_concepts(facts, concept, registry)
    assert counts(rows) == {"vitals": 3, "vitals:3020891": 1, None: 2}
    assert rows.where("external_id is null").first().ui_display_name is None


def test_death_view_has_an_empty_visit(death):
    view = death_view(death)
    assert view.columns[3] == "visit_occurrence_id" and view.where("visit_occurrence_id is not null").count() == 0


def test_omop_extract(person, concept, death, make):
    location = make("location_id long, zip string, state string", (1, "98101", "WA"))
    rows = extracts.demographic_extract_omop(person, concept, location, death)
    assert len(rows.columns) == 16
    assert got(rows, "personId", "addressState", "gender", "ethnicity", "hispanicBoolean", "deceasedBoolean", "mrn") == [
        ("1", "WA", "F", "Hispanic or Latino", True, True, None),
        ("1", "WA", "F", "Hispanic or Latino", True, True, None),  # two death rows
        ("2", None, "F", None, False, False, None),
        ("3", None, None, None, False, False, None),
    ]


def test_pcornet_extract(make):
    rows = make("patid long, birth_date date, sex string, hispanic string, race string",
                (1, BORN.date(), "F", "Y", "05"), (2, BORN.date(), "X", None, "UN"), (3, BORN.date(), None, "N", None))
    deaths = make("patid long, death_date date", (2, date(2020, 5, 1)), (2, date(2020, 4, 1)))
    found = got(extracts.demographic_extract_pcornet(rows, deaths), "personId", "deceasedDateTime", "ethnicity", "gender", "race", "hispanicBoolean", "deceasedBoolean", "name")
    assert found == [
        (1, None, "Hispanic or Latino", "Female", "White", True, False, "Unknown Unknown"),
        (2, date(2020, 4, 1), "Not Hispanic or Latino", "Other", "Unknown", False, True, "Unknown Unknown"),
        (3, None, "Not Hispanic or Latino", "Other", "Other", False, False, "Unknown Unknown"),
    ]


def concepts(make, *rows):
    frame = make("external_id string, kind string, field string, lo string, hi string, value_field string, value string, other string", *rows)
    return as_catalog(
        frame, predicate=predicate("d", *[F.col(c) for c in ("kind", "field", "lo", "hi", "value_field", "value", "other")])
    )


def test_every_kind_of_predicate(make):
    facts = make(
        "person_id long, code string, result string, concept int",
        (1, "A1", "+", 5), (1, "A1", "-", 5), (2, "A2", "+", 6), (3, "B1", None, 7), (3, "B1", None, 7), (4, None, None, None),
    )
    rows = concepts(
        make,
        ("all", "all", None, None, None, None, None, None), ("eq", "eq", "code", "A1", "A1", None, None, None),
        ("same eq", "eq", "code", "A1", "A1", None, None, None), ("in", "in", "code", "A1", "B1", None, None, None),
        ("between", "between", "code", "A15", "Z", None, None, None), ("none", "eq", "code", "Q", "Q", None, None, None),
        ("below", "descendant_of", "concept", "1", None, None, None, None),
        ("value", "eq", "code", "A1", None, "result", "+", None),
        ("dead", "exists", None, None, None, None, None, "x"), ("living", "not_exists", None, None, None, None, None, "x"),
    )
    ancestors = make("ancestor_concept_id int, descendant_concept_id int", (1, 5), (1, 7), (1, 5), (2, 6))
    datasets = {"d": cohort.Dataset(facts), "x": cohort.Dataset(make("person_id long", 2, 9))}
    assert dict(got(cohort.cohort_counts(rows, datasets, ancestors))) == {
        "all": 4, "eq": 1, "same eq": 1, "in": 2, "between": 2, "none": 0, "below": 2, "value": 1, "dead": 1, "living": 3,
    }


def test_fixed_concepts_over_their_tables(spark, make):
    registry = dataset_registry(spark, "pcornet")
    datasets = {
        "dbo.DEMOGRAPHIC": cohort.Dataset(make("PATID long, SEX string, HISPANIC string, RACE string", (1, "F", "Y", "05"), (2, "M", "N", "06")), "PATID"),
        "dbo.DEATH": cohort.Dataset(make("PATID long", 2), "PATID"),
    }
    with pytest.raises(ValueError, match="no dataset"):
        cohort.cohort_counts(fixed_catalog(spark, registry), datasets)
    counts = got(cohort.cohort_counts(fixed_catalog(spark, registry), datasets, allow_missing=True))
    found = {k.rsplit("demographic", 1)[1]: n for k, n in counts if n is not None}
    assert len(found) < len(counts)
    assert found == {
        "": 2, ":sex": 2, ":sex:F": 1, ":sex:M": 1, ":ethnicity": 2, ":ethnicity:Y": 1, ":ethnicity:N": 1, ":ethnicity:U": 0,
        ":race": 2, ":race:01": 0, ":race:02": 0, ":race:03": 0, ":race:04": 0, ":race:05": 1, ":race:06": 1, ":age": 2,
        ":vital": 2, ":vital:L": 1, ":vital:D": 1,
    }


def test_ages_and_measured_numbers(person, concept, death, make, registry):
    facts = make("person_id long, measurement_concept_id int, value_as_number double", (1, 3020891, 36.5), (2, 3020891, None), (3, 3027018, 60.0))
    catalog = people.demographic_concepts(person, concept, death, registry).unionByName(people.vital_concepts(facts, concept, registry))
    datasets = {"dbo.person": cohort.Dataset(person), "dbo.measurement": cohort.Dataset(facts)}
    found = got(cohort.numeric_concept_values(catalog, datasets, date(2001, 1, 1)))
    assert found == [("demographics:age", n, 366 / 365.25) for n in (1, 2, 3)] + [("vitals:3020891", 1, 36.5)]


def test_numbers_of_result_and_range_concepts(make):
    facts = make(
        "person_id long, code string, result string, value_as_number double",
        (1, "7", "45", 1.5), (2, "7", "46", 2.5), (3, "8", "45", 3.5), (4, "7", "45", None),
    )
    catalog = concepts(
        make, ("one", "eq", "code", "7", None, None, None, None), ("result", "eq", "code", "7", None, "result", "45", None),
        ("range", "between", "code", "7", "8", None, None, None), ("two", "in", "code", "7", "9", None, None, None),
    ).withColumns({"is_numeric": F.lit(True), "sql_field_numeric": F.lit("@.value_as_number")})
    found = got(cohort.numeric_concept_values(catalog, {"d": cohort.Dataset(facts)}, date(2001, 1, 1)))
    assert found == [
        ("one", 1, 1.5), ("one", 2, 2.5), ("range", 1, 1.5), ("range", 2, 2.5), ("range", 3, 3.5),
        ("result", 1, 1.5), ("two", 1, 1.5), ("two", 2, 2.5),
    ]


def test_a_hot_code_and_a_hot_person(spark, make):
    """A third of all rows are one code of one person."""
    facts = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("person_id"),
        F.when(F.col("id") % 3 == 0, "C5").otherwise(F.concat(F.lit("C"), (F.col("id") % 10).cast("string"))).alias("code"),
    )
    rows = concepts(make, ("five", "eq", "code", "C5", None, None, None, None), ("all codes", "between", "code", "C0", "C9", None, None, None))
    expected = facts.where("code = 'C5'").select("person_id").distinct().count()
    assert dict(got(cohort.cohort_counts(rows, {"d": cohort.Dataset(facts)}))) == {
        "five": expected, "all codes": facts.select("person_id").distinct().count(),
    }


def test_parquet_tables(spark, make, tmp_path):
    make("a int", 1).write.parquet(f"{tmp_path}/person.parquet")
    assert ParquetTables(spark, str(tmp_path))["person"].count() == 1


def test_ranges_meet_groups_of_codes(make, monkeypatch):
    """Six hundred codes in the same three ranges are admitted as one; persons may be named by texts."""
    sizes = {}
    monkeypatch.setattr(cohort, "materialize", lambda df, label: sizes.setdefault(label, (out := materialize(df, label)).count()) and out or out)
    facts = make("person_id string, code string", *[(f"p{i % 9}", f"C{i:03d}") for i in range(600)], ("q", "D"), (None, "C001"))
    rows = concepts(make, *[(f"r{i}", "between", "code", f"{c}", "C9", None, None, None) for i, c in enumerate("ABC")])
    assert dict(got(cohort.cohort_counts(rows, {"d": cohort.Dataset(facts)}))) == {"r0": 9, "r1": 9, "r2": 9}
    assert sizes["admitted"] == 3
