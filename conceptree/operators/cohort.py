"""Evaluating concepts: how many people each predicate selects, and numeric values.

Predicates are evaluated from their columns, not from their text. Whatever the test, it
comes down to the codes it admits; people are then found by one equi-join on the code.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, Row, functions as F

from conceptree.functions.bitmaps import people_above, set_sizes
from conceptree.functions.numbering import number_rows
from conceptree.functions.ranges import code_groups, match_ranges
from conceptree.functions.tables import union_all
from conceptree.functions.text import age_in_years
from conceptree.session import at_once, materialize


@dataclass
class Dataset:
    """A table concepts select from: its person column and the rows that count."""

    rows: DataFrame
    person: str = "person_id"
    where: dict[str, Column] = field(default_factory=dict)  # code column -> extra condition

    def people(self) -> DataFrame:
        return self.rows.select(F.col(self.person).alias("person")).where("person is not null").distinct()

    def coded_people(self, code: str, value: str | None = None) -> DataFrame:
        """Distinct (code, person), or (code, value, person), combined before the shuffle."""
        rows = self.rows.where(self.where[code]) if code in self.where else self.rows
        columns = [F.col(code).cast("string").alias("code"), F.col(self.person).alias("person")]
        if value:
            columns.append(F.col(value).cast("string").alias("value"))
        return rows.select(*columns).where("code is not null and person is not null").distinct()


def admitted_codes(
    tests: DataFrame, codes: Callable[[], DataFrame], ancestors: DataFrame | None = None
) -> DataFrame:
    """Distinct (test_id, value, code) that the tests for several codes let through.

    ``tests`` has test_id, kind, lo, hi, value; ``codes()`` gives the codes in the data,
    which only ranges need.
    """
    kinds = {r["kind"] for r in tests.select("kind").distinct().collect()}  # at most three
    found = []
    if "in" in kinds:
        listed = tests.where("kind = 'in'")
        found.append(listed.select("test_id", "value", F.explode(F.array("lo", "hi")).alias("code")))
    if "between" in kinds:
        spans = tests.where("kind = 'between'")
        found.append(spans.join(match_ranges(codes(), spans), ["lo", "hi"]).select("test_id", "value", "code"))
    if "descendant_of" in kinds:
        above = tests.where("kind = 'descendant_of'").select(
            "test_id", "value", F.col("lo").cast("long").alias("ancestor_concept_id")
        )
        found.append(
            ancestors.select("ancestor_concept_id", "descendant_concept_id")
            .join(above, "ancestor_concept_id")
            .select("test_id", "value", F.col("descendant_concept_id").cast("string").alias("code"))
        )
    return union_all(*found).distinct()


def range_join_codes(facts: DataFrame, code: str, concepts: DataFrame) -> DataFrame:
    """Facts joined to the concepts whose code range (columns lo, hi) covers ``code``.

    The ranges meet the distinct codes, not the facts; the facts follow by an equi-join
    with that result, which is stored so that its true size decides how it is joined.
    """
    codes = facts.select(F.col(code).alias("code")).distinct()
    covered = materialize(concepts.join(match_ranges(codes, concepts), ["lo", "hi"]), "covered")
    return facts.join(covered, facts[code] == covered["code"]).drop("code")


def cohort_counts(
    catalog: DataFrame,
    datasets: dict[str, Dataset],
    ancestors: DataFrame | None = None,
    allow_missing: bool = False,
) -> DataFrame:
    """(external_id, patient_count): distinct people of its dataset that satisfy each concept.

    A concept whose dataset is not given is an error, or with ``allow_missing`` has a null
    count. Equal predicates are evaluated
    once, under a number: people are then told apart by two numbers, not by long texts.
    """
    given = F.coalesce(F.col("predicate.dataset").isin(list(datasets)), F.lit(False))
    missing = catalog.where(~given)
    if not allow_missing and (first := missing.select("external_id", "predicate.dataset").first()):
        raise ValueError(f"{first['external_id']}: no dataset {first['dataset']} is given")
    concepts = materialize(
        catalog.where(given).select("external_id", F.to_json("predicate").alias("test"), "predicate"), "concepts"
    )
    uncounted = missing.select("external_id", F.lit(None).cast("long").alias("patient_count")).distinct()
    tests = number_rows(concepts.select("test", "predicate.*").distinct(), ["test"], "test_id")

    def count(group: Row) -> DataFrame:
        mine, data = _only(tests, group), datasets[group["dataset"]]
        if group["field"] is None:
            return _whole_counts(mine, data, datasets.get(group["other"]))
        return _coded_counts(mine, data, group["field"], ancestors)

    # As many rows as there are datasets and tested columns, however many concepts.
    groups = tests.select("dataset", "field", "other").distinct().collect()
    if not groups:
        return uncounted
    counts = at_once(catalog.sparkSession, *[partial(count, group) for group in groups])
    found = tests.select("test", "test_id").join(union_all(*counts), "test_id", "left")
    counted = (
        concepts.select("external_id", "test")
        .distinct()
        .join(found, "test")
        .select("external_id", F.coalesce("patient_count", F.lit(0)).alias("patient_count"))
    )
    return counted.unionByName(uncounted) if allow_missing else counted


def _only(tests: DataFrame, group: Row) -> DataFrame:
    for column, value in group.asDict().items():
        tests = tests.where(F.col(column).eqNullSafe(F.lit(value)))
    return tests


def _whole_counts(tests: DataFrame, data: Dataset, other: Dataset | None) -> DataFrame:
    """Everyone in the dataset, or those who are, or are not, in the other one too."""
    people = data.people()
    if other is None:
        return tests.select("test_id", people.agg(F.count(F.lit(1))).scalar().alias("patient_count"))
    both = people.join(other.people().withColumn("there", F.lit(True)), "person", "left").agg(
        F.create_map(
            F.lit("exists"), F.count("there"), F.lit("not_exists"), F.count_if(F.col("there").isNull())
        )
    )
    return tests.withColumn("by_kind", both.scalar()).select(
        "test_id", F.element_at("by_kind", F.col("kind")).alias("patient_count")
    )


def _coded_counts(tests: DataFrame, data: Dataset, code: str, ancestors: DataFrame | None) -> DataFrame:
    """Counts of the tests on one column, some of them with one more column.

    The facts are read once for each further column; its stored people, without that
    column, then serve the tests that have none.
    """
    columns = [r[0] for r in tests.select("value_field").distinct().collect()]  # the tested columns
    stored = {c: materialize(data.coded_people(code, c), "people") for c in columns if c}
    if None in columns:
        plain = next(iter(stored.values())).drop("value").distinct() if stored else data.coded_people(code)
        stored[None] = materialize(plain, "people")
    return union_all(
        *[
            _people_counts(tests.where(F.col("value_field").eqNullSafe(F.lit(c))), people, c, ancestors)
            for c, people in stored.items()
        ]
    )


def _people_counts(tests: DataFrame, people: DataFrame, value: str | None, ancestors: DataFrame | None) -> DataFrame:
    on = ["code", "value"] if value else ["code"]
    # The people of one code are distinct already: a plain count, no second shuffle of them.
    by_code = people.groupBy(*on).agg(F.count(F.lit(1)).alias("patient_count"))
    single = tests.where("kind = 'eq'").select("test_id", F.col("lo").alias("code"), "value")
    counts = (single if value else single.drop("value")).join(by_code, on).select("test_id", "patient_count")

    several = tests.where("kind <> 'eq'")
    if several.isEmpty():
        return counts
    people = _numbered(people)
    ranges, lists = several.where("kind = 'between'"), several.where("kind <> 'between'")
    if not ranges.isEmpty():
        # The codes that lie in the same ranges count as one.
        groups = materialize(code_groups(people.select("code"), ranges), "code_groups")
        grouped = people.join(groups, "code").drop("code").withColumnRenamed("first", "code")
        firsts = groups.select(F.col("first").alias("code"))
        counts = counts.unionByName(_reached(grouped, admitted_codes(ranges, lambda: firsts), on))
    if not lists.isEmpty():
        counts = counts.unionByName(_reached(people, admitted_codes(lists, lambda: people.select("code"), ancestors), on))
    return counts


def _numbered(people: DataFrame) -> DataFrame:
    """``people`` with whole numbers for persons, as bitmaps need them."""
    if people.schema["person"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        return people
    numbers = number_rows(people.select("person").distinct(), ["person"], "_number")
    others = [c for c in people.columns if c != "person"]
    return materialize(people.join(numbers, "person").select(*others, F.col("_number").alias("person")), "people")


def _reached(people: DataFrame, admitted: DataFrame, on: list[str]) -> DataFrame:
    """(test_id, patient_count): distinct people of the codes that each test admits."""
    key = F.struct(*on) if len(on) > 1 else F.col(on[0])
    known = " and ".join(f"{c} is not null" for c in on)
    links = materialize(admitted.where(known).select(key.alias("key"), "test_id"), "admitted")
    rows = people.where(known).select(key.alias("key"), "person")
    return set_sizes(people_above(rows, "key", "person", links, "key", "test_id"), "test_id", "patient_count")


def numeric_concept_values(
    catalog: DataFrame, datasets: dict[str, Dataset], as_of: date, ancestors: DataFrame | None = None
) -> DataFrame:
    """(external_id, person_id, value) of the numeric concepts: ages and measured numbers.

    A measured number belongs to every numeric concept whose whole test its row passes, result
    concepts and tests for several codes included.
    """
    numeric = materialize(
        catalog.where("is_numeric").select("external_id", F.col("sql_field_numeric").alias("number"), "predicate.*"),
        "numeric",
    )
    parts = []
    for name, data in datasets.items():
        mine = numeric.where(F.col("dataset") == name)
        person = F.col(data.person).cast("long").alias("person_id")
        columns = {c.lower(): c for c in data.rows.columns}
        for birth in ("birth_datetime", "birth_date"):
            if birth in columns:
                # The age concepts, a few fixed ones, as one list: a join of all people would have one key.
                ages = mine.where(F.col("number").contains("DATEDIFF")).agg(F.collect_list("external_id")).scalar()
                age = age_in_years(F.col(columns[birth]), F.lit(as_of).cast("date"))
                parts.append(data.rows.select(F.explode(ages).alias("external_id"), person, age.alias("value")))
        if "value_as_number" in columns:
            parts += _measured_numbers(mine.where("number = '@.value_as_number'"), data, person, ancestors)
    return union_all(*parts)


def _measured_numbers(
    numeric: DataFrame, data: Dataset, person: Column, ancestors: DataFrame | None
) -> list[DataFrame]:
    """One frame for each tested column, further column, and kind of test (one code or several)."""
    tests = numeric.select(F.col("external_id").alias("test_id"), "field", "kind", "lo", "hi", "value_field", "value")
    parts = []
    # As many rows as there are tested columns, however many concepts.
    for field, value_field in tests.select("field", "value_field").where("field is not null").distinct().collect():
        mine = tests.where((F.col("field") == field) & F.col("value_field").eqNullSafe(F.lit(value_field)))
        rows = data.rows.where(data.where[field]) if field in data.where else data.rows
        on = ["code", "value"] if value_field else ["code"]
        columns = [F.col(field).cast("string").alias("code")]
        if value_field:
            columns.append(F.col(value_field).cast("string").alias("value"))
        numbers = rows.where("value_as_number is not null").select(person, *columns, F.col("value_as_number").alias("number"))
        admitted = [mine.where("kind = 'eq'").select("test_id", F.col("lo").alias("code"), "value")]
        several = mine.where("kind <> 'eq'")
        if not several.isEmpty():
            codes = lambda numbers=numbers: numbers.select("code")
            admitted.append(admitted_codes(several, codes, ancestors).select("test_id", "code", "value"))
        admitted = materialize(union_all(*admitted).select("test_id", *on).distinct(), "admitted")
        found = numbers.join(admitted, on)
        parts.append(found.select(F.col("test_id").alias("external_id"), "person_id", F.col("number").alias("value")))
    return parts
