import random

import pytest
from conftest import got

from conceptree.functions.tables import append_absent
from conceptree.operators import hierarchy
from conceptree.operators.hierarchy import (
    backfill_ancestors,
    closure_delta,
    descendant_closure,
    extended_closure,
    hierarchy_levels,
    parent_link,
    root_assign,
    transitive_closure,
)
from conceptree.schema import as_catalog
from conceptree.session import materialize

LEVELS = "parent_concept_id int, concept_id int"


def closure(make, *edges):
    return got(transitive_closure(make(LEVELS, (None, 1), *edges)))


def test_chain(make):
    assert closure(make, (1, 2), (2, 3)) == [(1, 2, 1, 1), (1, 3, 2, 2), (2, 3, 1, 1)]


def test_unequal_path_lengths(make):
    assert (1, 3, 1, 2) in closure(make, (1, 2), (2, 3), (1, 3))


def test_diamond_counts_once(make):
    pairs = closure(make, (1, 2), (1, 3), (2, 4), (3, 4))
    assert pairs == [(1, 2, 1, 1), (1, 3, 1, 1), (1, 4, 2, 2), (2, 4, 1, 1), (3, 4, 1, 1)]


def test_cycle_is_an_error(make):
    with pytest.raises(ValueError, match="cycle"):
        transitive_closure(make(LEVELS, (1, 2), (2, 1)))


def test_random_graph_equals_path_enumeration(make):
    rng = random.Random(3)
    edges = {(i, j) for j in range(2, 30) for i in rng.sample(range(1, j), min(j - 1, rng.randint(1, 3)))}
    children = {}
    for parent, child in edges:
        children.setdefault(parent, []).append(child)
    expected = {}

    def walk(top, node, steps):
        for child in children.get(node, []):
            low, high = expected.get((top, child), (steps, steps))
            expected[top, child] = (min(low, steps), max(high, steps))
            walk(top, child, steps + 1)

    for top in children:
        walk(top, top, 1)
    assert closure(make, *edges) == sorted(((a, d, *s) for (a, d), s in expected.items()), key=repr)


def test_levels_keep_the_smallest_depth_and_the_vocabulary(make):
    concept = make(
        "concept_id int, concept_name string, concept_code string, vocabulary_id string",
        (1, "Root", "r", "LOINC"), (2, "A", "a", "LOINC"), (3, "B", "b", "LOINC"), (4, "X", "x", "SNOMED"),
    )
    relation = make(
        "concept_id_1 int, concept_id_2 int, relationship_id string",
        (2, 1, "Is a"), (3, 2, "Is a"), (3, 1, "Is a"), (4, 1, "Is a"), (2, 2, "Is a"), (1, 3, "Maps to"),
    )
    levels = hierarchy_levels(concept, relation, 1)
    assert got(levels, "parent_concept_id", "parent_concept_name", "depth", "concept_id") == [
        (1, "Root", 2, 2), (1, "Root", 2, 3), (2, "A", 3, 3), (None, None, 1, 1),
    ]


def test_backfill_keeps_existing_levels(make):
    schema = "ancestor_concept_id int, descendant_concept_id int, min_levels_of_separation int, max_levels_of_separation int"
    table = backfill_ancestors(make(schema, (1, 2, 9, 9)), make(schema, (1, 2, 1, 1), (1, 3, 2, 2)))
    assert got(table) == [(1, 2, 9, 9), (1, 3, 2, 2)]


def test_descendants_stop_at_the_depth(make):
    chain = make("parent_aui string, aui string", *[(f"n{i:02}", f"n{i + 1:02}") for i in range(12)])
    nodes = make("aui string", *[f"n{i:02}" for i in range(13)])
    pairs = got(descendant_closure(chain, nodes, max_depth=10))
    assert ("n00", "n10") in pairs and ("n00", "n11") not in pairs and ("n05", "n05") in pairs
    assert len([p for p in pairs if p[0] == "n00"]) == 11


def catalog(make, *rows):
    frame = make("id long, external_id string, external_parent_id string, is_root boolean, parent_id long, root_id long", *rows)
    return as_catalog(frame)


def test_link_only_where_empty_and_smallest_id(make):
    rows = catalog(
        make, (1, "a", None, True, None, None), (2, "a", None, False, None, None),
        (3, "b", "a", False, None, None), (4, "c", "a", False, 77, None), (5, "d", "none", False, None, None),
    )
    assert got(parent_link(rows), "id", "parent_id") == [(1, None), (2, None), (3, 1), (4, 77), (5, None)]
    again = parent_link(rows, relink=rows.where("external_id = 'c'").select("external_id"))
    assert got(again, "id", "parent_id") == [(1, None), (2, None), (3, None), (4, 1), (5, None)]


def test_roots_reach_down_only_where_empty(make):
    rows = catalog(
        make, (1, "a", None, True, None, None), (2, "b", "a", False, 1, None),
        (3, "c", "b", False, 2, 50), (4, "d", "c", False, 3, None), (5, "e", None, False, None, None),
    )
    assert got(root_assign(rows), "id", "root_id") == [(1, 1), (2, 1), (3, 50), (4, 1), (5, None)]


def test_append_absent_twice_adds_nothing(make):
    target, new = make("k string, v int", ("a", 1)), make("k string, v int", ("a", 2), ("b", 3))
    once = append_absent(target, new, ["k"])
    assert got(once) == [("a", 1), ("b", 3)] and got(append_absent(once, new, ["k"])) == got(once)


def test_a_deep_chain_is_followed_to_its_end(make):
    edges = make("parent_aui string, aui string", *[(f"n{i}", f"n{i + 1}") for i in range(24)])
    nodes = make("aui string", *[f"n{i}" for i in range(25)])
    assert descendant_closure(edges, nodes).where("aui = 'n0'").count() == 25
    assert descendant_closure(edges, nodes, max_depth=10).where("aui = 'n0'").count() == 11


def test_a_cycle_ends_the_closure(make):
    edges = make("parent_aui string, aui string", ("a", "b"), ("b", "a"))
    assert got(descendant_closure(edges, make("aui string", "a", "b"))) == [("a", "a"), ("a", "b"), ("b", "a"), ("b", "b")]


def test_a_chain_takes_few_rounds(make, monkeypatch):
    stored = []
    monkeypatch.setattr(hierarchy, "materialize", lambda df, label: stored.append(label) or materialize(df, label))
    pairs = closure(make, *[(i, i + 1) for i in range(1, 64)])
    assert len(pairs) == 64 * 63 // 2 and (1, 64, 63, 63) in pairs
    assert len(stored) == 7  # the links, then paths of up to 2, 4, 8, 16, 32 and 64 steps


def test_descendants_of_a_chain_and_a_cycle(make):
    links = [(f"n{i}", f"n{i + 1}") for i in range(20)] + [("n20", "n0"), ("x", "n3")]
    edges = make("parent_aui string, aui string", *links)
    found = got(descendant_closure(edges, make("aui string", "n0", "x", "alone")))
    every = [f"n{i}" for i in range(21)]
    assert found == sorted([("n0", n) for n in every] + [("x", n) for n in every] + [("x", "x"), ("alone", "alone")], key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_added_edges_equal_a_rebuild(make, seed):
    rng = random.Random(seed)
    edges = sorted({(i, j) for j in range(2, 25) for i in rng.sample(range(1, j), min(j - 1, rng.randint(1, 2)))})
    new = [e for e in edges if rng.random() < 0.3] + [(30, 31)]
    old = [e for e in edges if e not in new]
    stored = materialize(transitive_closure(make(LEVELS, *old)), "stored")
    assert got(extended_closure(stored, make(LEVELS, *new))) == closure(make, *old, *new)
    assert got(closure_delta(stored, make(LEVELS, *old))) == []


def test_an_added_edge_that_closes_a_cycle(make):
    stored = materialize(transitive_closure(make(LEVELS, (1, 2), (2, 3))), "stored")
    with pytest.raises(ValueError, match="cycle"):
        closure_delta(stored, make(LEVELS, (3, 1)))


def test_rounds_leave_the_tips_out(make, monkeypatch):
    """Tips, mostly the greater part of a hierarchy, are joined once and not in every round."""
    sizes = []
    monkeypatch.setattr(hierarchy, "materialize", lambda df, label: sizes.append((label, (out := materialize(df, label)).count())) or out)
    edges = [(i, i + 1) for i in range(1, 5)] + [(5, 100 + i) for i in range(200)] + [(2, 100)]
    pairs = closure(make, *edges)
    assert (1, 101, 5, 5) in pairs and (1, 100, 2, 5) in pairs and (5, 100, 1, 1) in pairs and len(pairs) == 10 + 5 * 200
    assert max(n for label, n in sizes if label == "closure") == 10


def test_added_tips_are_not_collected(spark, make):
    """The old closure grows with the hierarchy: it is not sent around whole, even where its file is small."""
    old = materialize(make("ancestor_concept_id int, descendant_concept_id int, min_levels_of_separation int, max_levels_of_separation int", (1, 2, 1, 1)), "old")
    added = make("parent_concept_id int, concept_id int", *[(2, 10 + i) for i in range(20)])
    extended = hierarchy.extended_closure(old, added)
    assert extended.count() == 1 + 2 * 20
    assert "BroadcastHashJoin" not in extended._jdf.queryExecution().executedPlan().toString()
