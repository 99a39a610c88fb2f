"""A code that holds a third of all rows is split where it meets the ancestors."""

import pytest
from pyspark.sql import functions as F

from conceptree.operators import labs
from conceptree.operators.registry import dataset_registry
from conceptree.session import materialize


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_code(spark, make, no_broadcast):
    tips = 50
    edges = [(None, 1, "root")] + [(1, 100 + i, f"n{i}") for i in range(tips)]
    levels = make("parent_concept_id int, concept_id int, concept_name string", *edges)
    people = materialize(
        spark.range(300_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 100).otherwise(100 + F.col("id") % tips).cast("int").alias("concept_id"),
            F.lit(None).cast("int").alias("value_id"),
            F.col("id").alias("person_id"),
            F.lit(False).alias("has_number"),
        ),
        "people",
    )
    above = make("ancestor_concept_id int, descendant_concept_id int", *[(1, 100 + i) for i in range(tips)])
    candidates = materialize(labs.lab_candidates(levels, dataset_registry(spark, "omop")), "candidates")
    counted = labs.closure_counts(candidates, people, above)
    counts = {r.concept_id: r.ui_display_patient_count for r in counted.select("concept_id", "ui_display_patient_count").collect()}
    assert counts[1] == 300_000 and counts[100] >= 100_000 and sum(v for k, v in counts.items() if k != 1) == 300_000

    joined = people.select("concept_id", "person_id").join(
        above, F.col("concept_id") == F.col("descendant_concept_id")
    ).select("ancestor_concept_id", "person_id").distinct()
    assert joined.count() == 300_000
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
