"""Ids with more vectors than places, against brute force."""

import random

from conftest import got

from conceptree.llm import topk


def test_ids_with_many_vectors(make, monkeypatch):
    monkeypatch.setattr(topk, "PIVOTS", 3)
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(60)]
    rows += [(7, [3.0 + j / 8, 3.0, 3.0]) for j in range(12)] + [(20, [rng.uniform(-1, 1) for _ in range(3)]) for _ in range(9)]
    check(make, rows)


def test_classes_of_equal_vectors(make, monkeypatch):
    monkeypatch.setattr(topk, "PIVOTS", 6)
    monkeypatch.setattr(topk, "ANNULUS", 4)
    monkeypatch.setattr(topk, "QUERIES", 2)
    rng = random.Random(4)
    hot = [0.5, -0.25, 1.0]
    kinds = [[rng.choice([-1.0, -0.5, 0.5, 1.0]) for _ in range(3)] for _ in range(30)]
    rows = [(i, hot if rng.random() < 0.4 else rng.choice(kinds)) for i in range(300)]
    check(make, [*rows, (7, hot), (20, kinds[0]), (40, hot), (40, hot), (301, [0.5, -0.25]), (302, [0.5, -0.25, 0.0])])
    check(make, [(i, hot) for i in range(90)])
    check(make, rows[:3])


def test_every_annulus_size_gives_the_same(make, monkeypatch):
    monkeypatch.setattr(topk, "PIVOTS", 8)
    monkeypatch.setattr(topk, "ANNULUS", 5)
    rng = random.Random(5)
    check(make, [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(200)])


def check(make, rows, k=4):
    vectors = [(i, [int(64 * x // 1) for x in map(float, v)]) for i, v in make("i long, v array<float>", *rows).collect()]
    wanted = []
    for query in {i for i, _ in vectors if i % 20 == 0}:
        best = {}
        for _, q in (row for row in vectors if row[0] == query):
            for i, v in vectors:
                if i != query:
                    best[i] = max(best.get(i, -(1 << 60)), sum(a * b for a, b in zip(q, v, strict=False)))
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        wanted += [(query, rank, i, score) for rank, (i, score) in enumerate(top, 1)]
    found = topk.exact_top_k(make("vec_id long, embedding array<float>", *rows), k=k)
    assert got(found, "query_id", "rank", "vec_id", "score") == sorted(wanted, key=repr)
