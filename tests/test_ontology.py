from conftest import got
from pyspark.sql import functions as F

from conceptree import fixed_values as fixed
from conceptree.operators.ontology import (
    CPT,
    ICD10,
    ICD10PCS,
    code_range_predicate,
    minmax_codes,
    ontology_nodes,
    universal_id_catalog,
)
from conceptree.operators.registry import dataset_registry, fixed_catalog
from conceptree.plans.pcornet import build_catalog_pcornet
from conceptree.plans.vocabulary import get_ontology, insert_concepts
from conceptree.schema import CONCEPT, ONTOLOGY
from conceptree.session import materialize

TERMS = "aui string, sab string, code string, tty string, str string"


def test_tests_for_one_two_and_more_codes(make):
    ranges = make(
        "aui string, min_code string, max_code string, code_count long",
        ("one", "A02.29", "A02.29", 1), ("two", "A41.81", "A41.89", 2), ("all", "A00.0", "Z99.89", 69823),
    )
    nodes = make("aui string, name string", ("one", "Salmonella"), ("two", "Sepsis"), ("all", "ICD-10-CM"))
    edges = make("parent_aui string, aui string", ("", "all"), ("all", "one"), ("two", "one"))
    rows = code_range_predicate(ranges, nodes, edges, "ICD10CM")
    assert got(rows, "aui", "parent_aui", "sql_set_where", "ui_display_name") == [
        ("all", None, "BETWEEN 'A00.0' AND 'Z99.89'", "ICD-10-CM (ICD10CM:A00.0-Z99.89)"),
        ("one", "all", "= 'A02.29'", "Salmonella (ICD10CM:A02.29)"),
        ("one", "two", "= 'A02.29'", "Salmonella (ICD10CM:A02.29)"),
        ("two", None, "IN ('A41.81','A41.89')", "Sepsis (ICD10CM:A41.81-A41.89)"),
    ]


def test_names_and_codes_of_nodes(make):
    terms = make(
        TERMS,
        ("R", "V", "0", "HT", "Root"), ("L", "V", "1", "AB", "short"), ("M", "V", "1", "PT", "the preferred name"),
        ("N", "V", "2", "AB", "own name"), ("Z", "V", "9", "PT", "no edge"),
    )
    edges = make("parent_aui string, aui string", ("", "R"), ("R", "L"), ("R", "N"), ("R", "gone"))
    assert got(ontology_nodes(edges, terms)) == [
        ("L", "1", False, "the preferred name"), ("N", "2", False, "own name"), ("R", None, True, "Root"),
    ]


def test_long_names_are_kept(make):
    terms = make(TERMS, ("L", "V", "1", "PT", "x" * 500))
    (row,) = ontology_nodes(make("parent_aui string, aui string", ("", "L")), terms).collect()
    assert row.name == "x" * 500


def test_nodes_without_codes_vanish(make):
    closure = make("aui string, child_aui string", ("R", "R"), ("R", "L"), ("E", "E"))
    nodes = make("aui string, code string", ("R", None), ("L", "5"), ("E", None))
    assert got(minmax_codes(closure, nodes)) == [("R", "5", "5", 1)]


def vocabulary(make):
    terms = make(
        TERMS, ("A1", "V", "R", "HT", "Root"), ("A2", "V", "G", "HT", "Group"), ("A3", "V", "a", "PT", "Alpha"),
        ("A4", "V", "b", "PT", "Beta"), ("A5", "W", "c", "PT", "Other vocabulary"),
    )
    paths = make("aui string, ptr string", ("A1", None), ("A2", "A1"), ("A3", "A1.A2"), ("A4", "A1.A2"), ("A5", "A1.A2"))
    return terms, paths


def test_ontology_of_one_vocabulary(make):
    assert got(get_ontology(*vocabulary(make), "V"), "aui", "parent_aui", "code_count", "sql_set_where") == [
        ("A1", None, 2, "IN ('a','b')"), ("A2", "A1", 2, "IN ('a','b')"), ("A3", "A2", 1, "= 'a'"), ("A4", "A2", 1, "= 'b'"),
    ]


def test_insert_twice_adds_nothing(spark, make):
    ontology = materialize(get_ontology(*vocabulary(make), "V"), "ontology")
    empty = spark.createDataFrame([], CONCEPT)
    once = materialize(insert_concepts(ontology, empty, "Had", 3, "@.Code "), "once")
    assert got(once, "id", "external_id", "parent_id", "is_parent", "is_root", "sql_set_where", "ui_display_text")[:2] == [
        (1, "UMLS_AUI:A1", None, True, True, "@.Code IN ('a','b')", "Had Root (V:a-b)"),
        (2, "UMLS_AUI:A2", 1, True, False, "@.Code IN ('a','b')", "Had Group (V:a-b)"),
    ]
    assert got(insert_concepts(ontology, once, "Had", 3), "id", "parent_id") == got(once, "id", "parent_id")


def ontology(make):
    rows = [
        ("R", None, "a", "c", 3, "V", "BETWEEN 'a' AND 'c'", "Root"),
        ("S", "R", "a", "c", 3, "V", "BETWEEN 'a' AND 'c'", "Same codes"),
        ("L", "S", "a", "a", 1, "V", "= 'a'", "L" * 500),
    ]
    return make(ONTOLOGY, *rows)


def test_ids_by_code_and_their_parents(spark, make):
    registry = dataset_registry(spark, "pcornet")
    rows = got(universal_id_catalog(ontology(make), registry, ICD10), "universal_id", "external_parent_id", "is_parent", "is_root", "sql_set_id")
    p = fixed.URN + "dx"
    assert rows == [
        (p, None, True, True, 3),
        (p + ":icd10:a", p + ":icd10:a_c_2", False, False, 3),
        (p + ":icd10:a_c", p, True, False, 3),
        (p + ":icd10:a_c_2", p + ":icd10:a_c", True, False, 3),
    ]


def test_whole_names_and_moved_children(spark, make):
    registry = dataset_registry(spark, "pcornet")
    long = {k.urn: max(len(r[0] or "") for r in universal_id_catalog(ontology(make), registry, k, t).select("ui_display_name").collect())
            for k, t in ((ICD10, None), (CPT, None), (ICD10PCS, "R"))}
    assert long == {"dx:icd10": 500, "px:cpt": 500, "px:icd10pcs": 500}
    p = fixed.URN + "px"
    assert got(universal_id_catalog(ontology(make), registry, ICD10PCS, "R"), "universal_id", "external_parent_id") == [
        (p + ":icd10pcs", p), (p + ":icd10pcs:a", p + ":icd10pcs:a_c_2"), (p + ":icd10pcs:a_c_2", p + ":icd10pcs"),
    ]


def test_registries(spark):
    rows = got(dataset_registry(spark, "omop", created_by="me"), "id", "sql_set_from", "is_encounter_based", "sql_field_date", "created_by")
    assert len(rows) == 9 and rows[0] == (1, "dbo.person", False, None, "me")
    assert (4, "dbo.v_death", True, "@.death_datetime", "me") in rows
    assert dataset_registry(spark, "pcornet", first_id=10).agg(F.max("id")).first()[0] == 17


def test_fixed_concepts(spark):
    rows = fixed_catalog(spark, dataset_registry(spark, "pcornet"))
    assert rows.count() == 24 and rows.where("is_root").count() == 2 and rows.where("sql_set_where is not null").count() == 17
    assert got(rows.where("external_id like '%race:05'"), "external_parent_id", "sql_set_where", "ui_display_name", "sql_set_id") == [
        (fixed.URN + "demographic:race", "@.RACE = '05'", "White", 1)
    ]
    assert rows.select("is_patient_count_auto_calculated").distinct().collect()[0][0] is None


def test_catalog_keeps_existing_concepts(spark, make):
    registry, source = dataset_registry(spark, "pcornet"), ontology(make)
    first = materialize(build_catalog_pcornet(registry, source, source, source, icd10pcs_top="R"), "first")
    again = build_catalog_pcornet(registry, source, source, source, existing=first, icd10pcs_top="R")
    assert got(again, "id", "universal_id", "parent_id", "root_id") == got(first, "id", "universal_id", "parent_id", "root_id")
    assert first.where("parent_id is null").count() == 4 and first.where("root_id is null").count() == 0


def test_several_nodes_without_parent(spark, make):
    registry = dataset_registry(spark, "pcornet")
    rows = [("A", None, "a", "b", 2, "V", "IN ('a','b')", "A"), ("B", None, "c", "d", 2, "V", "IN ('c','d')", "B"), ("C", "B", "c", "c", 1, "V", "= 'c'", "C")]
    names = ("aui", "parent_aui", "min_code", "max_code", "code_count", "ontology_type", "sql_set_where", "ui_display_name")
    tops = make(ONTOLOGY, *[tuple(dict(zip(names, r, strict=True)).get(n) for n in ONTOLOGY.names) for r in rows])
    p = fixed.URN + "dx"
    found = dict(got(universal_id_catalog(tops, registry, ICD10), "universal_id", "external_parent_id"))
    assert found == {p: None, f"{p}:icd10:a_b": p, f"{p}:icd10:c_d": p, f"{p}:icd10:c": f"{p}:icd10:c_d"}
    p = fixed.URN + "px"
    found = dict(got(universal_id_catalog(tops, registry, ICD10PCS, "A"), "universal_id", "external_parent_id"))
    assert found == {f"{p}:icd10pcs": p, f"{p}:icd10pcs:c_d": f"{p}:icd10pcs", f"{p}:icd10pcs:c": f"{p}:icd10pcs:c_d"}
