import random

from conftest import got

from conceptree.operators.paths import path_decode


def literal(rows, limit=60):
    """The rule, one token at a time."""
    live, found = [[a, p, ""] for a, p in rows], {}
    for turn in range(limit):
        live = [r for r in live if r[1] is not None]
        for row in live:
            head, dot, tail = row[1].partition(".")
            key = (head.strip(), row[2], row[0])
            found[key] = min(found.get(key, turn), turn)
            row[2] = head.strip()
            row[1] = (tail if dot else row[1]) or None
    deepest = {}
    for (_, _, aui), turn in found.items():
        deepest[aui] = max(deepest.get(aui, 0), turn)
    return {(before, code) for code, before, _ in found if code != before} | {
        (code, aui) for (code, _, aui), turn in found.items() if turn == deepest[aui]
    }


def decode(make, rows, **options):
    return got(path_decode(make("aui string, ptr string", *rows), **options))


def test_node_hangs_under_its_longest_paths(make):
    rows = [("L", "a.x"), ("L", "b.c.d.x"), ("L", "e.f.y")]
    expected = [("", "a"), ("", "b"), ("", "e"), ("a", "x"), ("b", "c"), ("c", "d"), ("d", "x"),
                ("e", "f"), ("f", "y"), ("x", "L"), ("y", "L")]
    assert decode(make, rows) == expected


def test_null_path_gives_nothing(make):
    assert decode(make, [("R", None)]) == []


def test_single_ancestor(make):
    assert decode(make, [("N", "R")]) == [("", "R"), ("R", "N")]


def test_a_limit_of_ancestors_on_request(make):
    for length in (19, 20, 22):
        path = [f"n{i}" for i in range(length)]
        edges = decode(make, [("L", ".".join(path))], max_tokens=20)
        assert set(edges) == literal([("L", ".".join(path))], 20)
        assert (path[min(length, 20) - 1], "L") in edges
    assert decode(make, [("L", "a.b.c")], max_tokens=2) == [("", "a"), ("a", "b"), ("b", "L")]


def test_final_dot(make):
    assert decode(make, [("L", "a.b.")]) == sorted(literal([("L", "a.b.")]))


def test_random_paths_equal_the_literal_rule(make):
    rng = random.Random(7)
    rows = []
    for case in range(400):
        for _ in range(rng.randint(1, 5)):
            steps = [f"{case}n{rng.randint(0, 6)}" for _ in range(rng.randint(1, 23))]
            rows.append((f"{case}L", ".".join(steps) + rng.choice(["", "", "."])))
    assert set(decode(make, rows)) == literal(rows)


def test_a_path_of_many_ancestors_is_read_whole(make):
    names = [f"s{i}" for i in range(25)]
    edges = decode(make, [("L", ".".join(names))])
    assert len(edges) == 26 and ("s24", "L") in edges
