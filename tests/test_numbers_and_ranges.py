import random

from conftest import got
from pyspark.sql import functions as F

from conceptree.functions.numbering import number_rows, number_within
from conceptree.functions.ranges import code_groups, match_ranges
from conceptree.operators.cohort import range_join_codes
from conceptree.operators.ontology import dedupe_suffix


def test_numbers_are_consecutive_in_order(spark):
    rows = spark.range(10_000).select(F.format_string("%06d", F.col("id") * 7919 % 10_007).alias("k"))
    numbered = got(number_rows(rows, ["k"], start=5), "id", "k")
    by_number = sorted(numbered)
    assert [n for n, _ in by_number] == list(range(5, 10_005))
    assert [k for _, k in by_number] == sorted(k for _, k in by_number)


def test_rank_of_a_key_that_holds_a_third_of_the_rows(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("k"),
        F.format_string("%06d", "id").alias("v"),
    )
    ranks = {}
    for key, value, rank in got(number_within(rows, "k", ["v"]), "k", "v", "rank"):
        ranks.setdefault(key, []).append((value, rank))
    for found in ranks.values():
        assert [rank for _, rank in sorted(found)] == list(range(1, len(found) + 1))
    assert len(ranks["hot"]) == 10_000


def test_suffixes(make):
    rows = make("k string, a string", ("x", "3"), ("x", "1"), ("x", "2"), ("y", "1"), (None, "1"))
    assert got(dedupe_suffix(rows, "k", ["a"])) == [
        ("x", "1"), ("x_2", "2"), ("x_3", "3"), ("y", "1"), (None, "1"),
    ]


def test_ranges_equal_brute_force(spark):
    rng = random.Random(11)
    codes = sorted({f"{rng.choice('ABC')}{rng.randint(0, 9999)}.{rng.randint(0, 9)}" for _ in range(13_000)})
    assert len(codes) > 2 * 4096  # more than two of the largest blocks
    ranges = [tuple(sorted(rng.sample(codes, 2))) for _ in range(12)]
    ranges += [(codes[0], codes[-1]), (codes[5], codes[5]), ("", "zzz"), ("A5", "A6"), ("B9", "B1"), ("D", "E")]
    found = match_ranges(
        spark.createDataFrame([(c,) for c in codes], "code string"),
        spark.createDataFrame(ranges, "lo string, hi string"),
    )
    assert found.count() == found.distinct().count()
    expected = {(lo, hi, c) for lo, hi in set(ranges) for c in codes if lo <= c <= hi}
    assert {tuple(r) for r in found.collect()} == expected


def test_diagnoses_in_ranges(make):
    facts = make("patient string, code string", ("A", "E11.2"), ("B", "T34.5"), ("C", "S09.1"))
    concepts = make("name string, lo string, hi string", ("all", "A00.0", "Z99.89"), ("injuries", "S00", "T98.9"), ("one", "E11.2", "E11.2"))
    joined = range_join_codes(facts, "code", concepts)
    assert got(joined, "patient", "name") == [
        ("A", "all"), ("A", "one"), ("B", "all"), ("B", "injuries"), ("C", "all"), ("C", "injuries"),
    ]


def test_suffixes_avoid_names_that_exist(make):
    rows = make("k string, a int", ("x", 1), ("x", 2), ("x_2", 3))
    assert got(dedupe_suffix(rows, "k", ["a"])) == [("x", 1), ("x_2", 3), ("x__2", 2)]


def test_codes_of_the_same_ranges_are_one_group(make):
    rng = random.Random(5)
    codes = sorted({f"{rng.randrange(3000):04d}" for _ in range(400)})
    ranges = [tuple(sorted((f"{rng.randrange(3000):04d}", f"{rng.randrange(3000):04d}"))) for _ in range(12)] + [(codes[7], codes[7])]
    found = dict(got(code_groups(make("code string", *codes, None), make("lo string, hi string", *ranges)), "code", "first"))
    held = lambda code: frozenset(r for r in ranges if r[0] <= code <= r[1])
    assert {c for c in codes if held(c)} <= set(found) and len(set(found.values())) <= 2 * len(ranges)
    assert all(held(c) == held(first) and first <= c for c, first in found.items())
