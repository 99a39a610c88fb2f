"""Interval labels against path enumeration."""

import random

import pytest
from conftest import got

from conceptree.functions.ranges import match_places
from conceptree.operators import intervals
from conceptree.operators.intervals import interval_labels, root_paths

EDGES = "above long, below long"


def pairs_of(edges):
    """Every node with itself and what is below it, by walking."""
    children, nodes = {}, set()
    for above, below in edges:
        nodes |= {above, below} - {None}
        if above is not None:
            children.setdefault(above, []).append(below)
    found = set()
    for top in nodes:
        todo = [top]
        while todo:
            node = todo.pop()
            if (top, node) not in found:
                found.add((top, node))
                todo += children.get(node, [])
    return sorted(found, key=repr)


def check(make, edges):
    labels = interval_labels(make(EDGES, *edges))
    assert got(labels.descendants()) == pairs_of(edges)
    spans = {}
    for node, a, b in got(labels.spans):
        spans.setdefault(node, []).append((a, b))
    assert all(x[1] <= y[0] for own in spans.values() for x, y in zip(sorted(own), sorted(own)[1:], strict=False))
    return labels


def test_tree(make):
    labels = check(make, [(None, 1), (1, 2), (1, 3), (2, 4), (2, 5), (3, 6)])
    assert labels.spans.count() == 6


def test_second_parents(make):
    check(make, [(1, 2), (1, 3), (2, 4), (3, 4), (4, 5), (5, 6), (3, 6)])


def test_links_that_meet_over_several_second_parents(make):
    check(make, [(1, 2), (2, 3), (10, 3), (3, 4), (11, 4), (9, 11), (4, 5), (8, 9), (7, 2), (7, 8), (20, 7)])


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(make, seed):
    rng = random.Random(seed)
    names = rng.sample(range(1, 500), 40)
    edges = {(names[i], names[j]) for j in range(3, 40) for i in rng.sample(range(j), min(j, rng.randint(1, 3)))}
    check(make, sorted(edges))


def test_wanted_nodes_and_roots(make):
    labels = interval_labels(make(EDGES, (1, 2), (2, 3), (5, 6), (None, 9)))
    assert got(labels.descendants(make("node long", 2, 9, 77))) == [(2, 2), (2, 3), (9, 9)]
    assert got(labels.places, "node", "root") == [(1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (9, 9)]


def test_nothing(make):
    labels = interval_labels(make(EDGES))
    assert got(labels.spans) == got(labels.places) == got(labels.descendants()) == []


@pytest.mark.parametrize("edges", [[(1, 1)], [(1, 2), (2, 3), (3, 1)], [(1, 2), (2, 3), (3, 4), (4, 2)], [(1, 2), (1, 3), (2, 4), (3, 4), (4, 3)]])
def test_cycle_is_an_error(make, edges):
    with pytest.raises(ValueError, match="cycle"):
        interval_labels(make(EDGES, *edges))


def test_a_chain_takes_few_rounds(make, monkeypatch):
    labels = []
    real = intervals.materialize
    monkeypatch.setattr(intervals, "materialize", lambda df, label: labels.append(label) or real(df, label))
    paths = dict(got(root_paths(make(EDGES, *[(i, i + 1) for i in range(1, 65)]))))
    assert paths[65] == list(range(1, 66))
    assert len(labels) <= 8


def test_places_meet_spans_once(make):
    rng = random.Random(5)
    spans = [(i, a, a + rng.randint(0, 9000)) for i, a in enumerate(rng.sample(range(9000), 30))]
    points = rng.sample(range(18000), 400)
    found = match_places(make("at long", *points), make("i int, a long, b long", *spans)).select("i", "at")
    assert got(found) == sorted(((i, p) for i, a, b in spans for p in points if a <= p < b), key=repr)
