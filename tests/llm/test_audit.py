"""The filter audit against brute force: every order walked document by document."""

from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from conceptree.llm.audit import Counters, audit_filters

PLAIN = " ".join(f"word{k}" for k in range(200))
ROWS = [
    (1, PLAIN, "en"), (2, PLAIN, "de"), (2, PLAIN, "en"), (3, None, None), (4, "", ""), (5, "AB 100%", "en"), (None, PLAIN, "en"),
    (6, "a b " * 150, "en"), (7, "a b " * 150, "en"), (8, PLAIN + " # AND CAPITALS MORE OF THEM, MANY MORE OF THEM, AND SO ON", "de"),
    (9, "x" * 100_000, "fr"), (10, "ÄÖ   A", "fr"),
]
LABELS = [(1, 1, 0), (2, 1, None), (2, 0, 1), (5, None, 1), (7, 0, 1), (6, 1, 0), (None, 1, 1), (99, 1, 1)]


def brute(rows, labels):
    words = lambda t: [w for w in "".join(" " if c in " \t\n\x0b\f\r" else c for c in t).split(" ") if w]
    texts = [(i, t or "", part or "") for i, t, part in rows]
    out = Counter()
    found = []
    for i, t, part in texts:
        w = words(t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and any(j is not None and j < i and t == s for j, s, _ in texts),
        }
        found.append((part, fails, any(a == i and b == 1 for a, b, _ in labels if a), any(a == i and c == 1 for a, _, c in labels if a)))
    for order in map("".join, permutations("ABCDE")):
        for part, fails, good, toxic in found:
            gone = False
            for step, f in enumerate(order, 1):
                key = (part, order, step)
                out[*key, "redundant"] += fails[f] and gone
                out[*key, "unique_fails"] += fails[f] and sum(fails.values()) == 1
                here = fails[f] and not gone
                out[*key, "removed"] += here
                out[*key, "good_lost"] += here and good
                out[*key, "toxic_lost"] += here and toxic
                out[part, f, "shapley"] += here
                gone |= fails[f]
                out[*key, "kept"] += not gone
    return out


@pytest.mark.parametrize("extra", [False, True])
def test_every_order(make, extra):
    docs = make("doc_id long, text string, lang string", *ROWS)
    if extra:
        docs = docs.withColumns({c: F.lit(1) for c in ("part", "mask", "digest", "first", "good", "toxic", "quality")})
    found = audit_filters(docs, make("doc_id long, quality int, toxic int", *LABELS)).collect()
    want = brute(ROWS, LABELS)
    assert len(found) == 600 * 4 and len({(r["part"], r["filter_order"], r["step"]) for r in found}) == 2400
    for r in found:
        key = (r["part"], r["filter_order"], r["step"])
        for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"):
            assert r[c] == want[*key, c], (key, c)
        assert r["shapley"] == want[r["part"], r["filter_order"][r["step"] - 1], "shapley"]


def test_empty(make):
    none, labels = make("doc_id long, text string, lang string"), make("doc_id long, quality int, toxic int")
    assert audit_filters(none, labels).count() == 0
    rows = audit_filters(make("doc_id long, text string, lang string", *ROWS), labels).agg(F.sum("good_lost"), F.sum("toxic_lost"))
    assert tuple(rows.first()) == (0, 0)


def test_fields_do_not_carry():
    counters = Counters()
    many = (1 << 62) + 12345
    outcomes, only = counters.unpack(counters.dump(counters.packed[0b10001] * many + counters.packed[0b00010] * 7))
    order = counters.orders.index("ABCDE")
    assert outcomes[order].tolist() == [[7, many, 0], [0, 7, 0], [0, 0, 0], [0, 0, 0], [0, 0, many]]
    assert only.tolist() == [0, 7, 0, 0, 0]
