import random

import pytest
from conftest import got

from conceptree.functions import bitmaps
from conceptree.functions.bitmaps import people_above, set_sizes
from conceptree.operators import labs, ontology
from conceptree.session import materialize
from conceptree.sources import stored
from conceptree.sources.stored import StoredTable, VersionTaken

ROWS = "k string, v int"


@pytest.fixture
def table(spark, make, tmp_path):
    return StoredTable(spark, f"{tmp_path}/t", make(ROWS).schema, "k", 4)


def test_versions(table, make):
    assert table.read().count() == 0 and table.version() == 0
    table.append(make(ROWS, ("a", 1), ("b", 2)))
    table.append(make(ROWS, ("b", 9), ("c", 3), ("c", 3), (None, 4)), ["k"])
    assert got(table.read()) == sorted([("a", 1), ("b", 2), ("c", 3), (None, 4)], key=repr)
    assert table.replace(table.read().where("v > 1")) == 3
    assert got(table.read(1)) == [("a", 1), ("b", 2)] and table.read().count() == 3
    table.replace(make(ROWS))
    assert table.read().count() == 0


def test_a_change_that_breaks_off_leaves_the_table(table, make, monkeypatch):
    table.append(make(ROWS, ("a", 1)))
    with pytest.raises(Exception, match="(?i)zero"):
        table.replace(make(ROWS, ("z", 0)).selectExpr("k", "cast(raise_error('zero') as int) as v"))
    monkeypatch.setattr(table, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.replace(make(ROWS, ("z", 0)))
    monkeypatch.undo()
    assert got(table.read()) == [("a", 1)] and table.version() == 1


def test_two_appends_do_not_write_a_key_twice(table, spark, make, monkeypatch):
    other = StoredTable(spark, table.path, table.schema, "k", 4)
    commit, first = table._commit, []

    def late(version, folders):
        if not first:
            first.append(other.append(make(ROWS, ("a", 1), ("b", 2)), ["k"]))
        commit(version, folders)

    monkeypatch.setattr(table, "_commit", late)
    assert table.append(make(ROWS, ("b", 7), ("c", 3)), ["k"]) == 2
    assert got(table.read()) == [("a", 1), ("b", 2), ("c", 3)]


def test_a_writer_that_always_comes_late(table, make, monkeypatch):
    monkeypatch.setattr(stored, "_RETRIES", 2)
    monkeypatch.setattr(table, "version", lambda: 0)
    table.append(make(ROWS, ("a", 1)))
    with pytest.raises(VersionTaken):
        table.append(make(ROWS, ("b", 1)))


def test_update_leaves_other_buckets(table, make):
    table.append(make(ROWS, *[(f"k{i}", i) for i in range(40)]))
    before = dict(table.folders())
    assert table.update(make("id string, new int", ("nobody", 1)), "id", "new", "v") == 2
    assert dict(table.folders()) == before
    table.update(make("id string, new int", ("k3", 100)), "id", "new", "v")
    after = dict(table.folders())
    assert sum(before[b] != after[b] for b in before) == 1
    assert got(table.read()) == sorted([(f"k{i}", 100 if i == 3 else i) for i in range(40)], key=repr)


def test_bitmaps_count_distinct_people(make):
    rng = random.Random(1)
    people = [0, 1, -1, -17, 15, 16, 32768 * 16, 32768 * 16 + 1, 10**12, -(10**9)] + [rng.randrange(10**6) for _ in range(300)]
    rows = [(rng.randrange(6), p) for p in people for _ in range(3)] + [(1, None)]
    links = [(0, 0), (1, 1), (10, 0), (10, 1), (10, 2), (11, 10), (11, 0), (11, 5)]
    sets = people_above(make("c int, p long", *rows), "c", "p", make("above int, below int", *links), "below", "above")
    want = {a: len({p for c, p in rows if p is not None and (a, c) in links}) for a, _ in links}
    assert dict(got(set_sizes(sets, "above", "n"))) == {a: n for a, n in want.items() if n}


def test_people_are_shuffled_once(make, spark):
    rows = materialize(make("c int, p long", (1, 1)), "rows")
    links = materialize(make("above int, below int", (1, 1)), "links")
    sets = people_above(rows, "c", "p", links, "below", "above")
    sets.collect()
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1


def test_small_sets_take_no_more_than_their_people(make):
    """A set of few people had 4 KB for each of its buckets."""
    rows = materialize(make("c int, p long", *[(i, i * 64) for i in range(50)]), "rows")
    links = make("above int, below int", *[(i, i) for i in range(50)], *[(100, i) for i in range(50)])
    sets = people_above(rows, "c", "p", links, "below", "above")
    assert sets.schema["people"].dataType.simpleString() == "bigint" and sets.count() == 100


def test_keys_below_the_same_meet_their_ancestors_once(make, monkeypatch):
    """300 tests below the same two: the people are joined to one group, and only its bitmaps to the two."""
    stored = {}
    monkeypatch.setattr(bitmaps, "materialize", lambda df, label: stored.setdefault(label, materialize(df, label)))
    links = make("above int, below int", *[(a, i) for a in (1000, 1001) for i in range(300)])
    sets = people_above(make("c int, p long", *[(i, i % 7) for i in range(300)]), "c", "p", links, "below", "above")
    assert got(set_sizes(sets, "above", "n")) == [(1000, 7), (1001, 7)] and stored["groups"].count() == 1


def test_a_link_to_nothing_keeps_its_set(make):
    links = make("above int, below int", (None, 1), (1, 1), (2, 1), (None, 2))
    sets = people_above(make("c int, p long", (1, 5), (2, 6), (2, 5)), "c", "p", links, "below", "above")
    assert got(set_sizes(sets, "above", "n")) == [(1, 1), (2, 1), (None, 2)]


def test_counts_renewed(make):
    links = make("ancestor_concept_id int, descendant_concept_id int", (1, 1), (1, 2), (1, 3), (2, 2), (3, 3), (4, 4))
    old = [(2, 1), (2, 2), (3, 2), (4, 9)]
    new = [(2, 2), (3, 1), (3, 70000), (3, 70000), (5, 1)]
    sets = materialize(labs.parent_sets(make("concept_id int, person_id long", *old), links), "sets")
    counts = set_sizes(sets, "concept_id", "patient_count")
    after, sets = labs.renewed_counts(counts, sets, make("concept_id int, person_id long", *new), links)
    assert got(after) == [(1, 3), (2, 2), (3, 3), (4, 1)] == got(set_sizes(sets, "concept_id", "patient_count"))


def test_member_intervals(make):
    nodes = make("aui string, code string", ("a", "A1"), ("b", "A2"), ("c", "A3"), ("d", "A4"), ("e", "A5"), ("e2", "A5"), ("top", None))
    closure = [(n, n) for n in ("a", "b", "c", "d", "e", "e2")] + [("top", n) for n in ("a", "b", "d", "e", "e2")] + [("all", n) for n in "abcde"]
    found = ontology.member_intervals(make("aui string, child_aui string", *closure), nodes)
    rows = got(found)
    assert ("top", "A1", "A2", 2) in rows and ("top", "A4", "A5", 2) in rows and ("all", "A1", "A5", 5) in rows and ("e2", "A5", "A5", 1) in rows
    tests = {r["aui"]: r["test"] for r in ontology.exact_tests(found, "@.DX").collect()}
    assert tests["top"] == "(@.DX IN ('A1','A2') OR @.DX IN ('A4','A5'))" and tests["all"] == "@.DX BETWEEN 'A1' AND 'A5'"
