"""What a vocabulary's copy reads, and that it is what the plain tables give."""

import pytest
from conftest import got

from conceptree.operators import ontology
from conceptree.session import materialize
from conceptree.sources.layout import VocabularyLayout

TERM = "aui string, sab string, code string, tty string, str string"


@pytest.fixture
def tables(make):
    terms = make(
        TERM, ("A1", "X", "1", "PT", "one"), ("A1", "X", "1", "SY", "uno"), ("A2", "X", "2", "HT", "two"), ("A3", "010", "3", "PT", "three"),
        ("A4", "Y", None, "PT", None), ("A4", "X", "4", "PT", "four"), ("A5", None, "5", "HT", "five"), (None, "X", "6", "PT", "six"),
    )
    paths = make("aui string, ptr string", ("A1", "A2"), ("A1", None), ("A2", None), ("A3", "A9"), ("A4", "A2"), ("A7", "A2"), (None, "A2"), ("A1", "A2"))
    return terms, paths


@pytest.fixture
def layout(spark, tables, tmp_path):
    layout = VocabularyLayout(spark, f"{tmp_path}/v")
    layout.write(*tables)
    return layout


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("vocabulary", ["X", "Y", "010", "absent"])
def test_same_rows_from_its_folder_alone(layout, tables, vocabulary):
    terms = ontology.vocabulary_terms(tables[0], vocabulary)
    assert got(layout.terms(vocabulary)) == got(terms)
    assert got(layout.paths(vocabulary)) == got(ontology.vocabulary_paths(tables[1], terms))
    read = layout.paths(vocabulary)
    assert "PartitionFilters: [isnotnull(sab" in plan(read) and "Join" not in plan(read)
    assert "Exchange" not in plan(read)


def test_wanted_vocabularies_prune_folders_at_run_time(layout, tables, make):
    listed = materialize(make("sab string, ask int", ("Y", 1), ("X", 0), ("010", 2), (None, 1)), "listed")
    wanted = listed.where("ask > 0").select("sab")
    found = layout.terms_of(wanted)
    assert got(found) == got(tables[0].where("sab in ('Y', '010')"), "aui", "sab", "code", "tty", "str")
    assert "dynamicpruning" in plan(found).lower()


def test_wanted_nodes_filter_the_paths(spark, layout, make, tmp_path):
    make("aui string, n int", *[(f"A{i}", i) for i in range(50)]).write.parquet(f"{tmp_path}/nodes")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = layout.paths_of(spark.read.parquet(f"{tmp_path}/nodes").where("n = 1").select("aui"), "X")
        assert got(found) == [("A1", "A2"), ("A1", "A2"), ("A1", None)]
        assert "might_contain" in plan(found)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_vocabularies(spark, tables, tmp_path):
    layout = VocabularyLayout(spark, f"{tmp_path}/none")
    layout.write(*[t.limit(0) for t in tables])
    assert layout.terms("X").count() == 0 and layout.paths("X").count() == 0
