import pytest
from conftest import got

from conceptree.sources.sinks import append_rows, replace_rows


def test_append_and_replace(make, spark, tmp_path):
    path = f"{tmp_path}/concepts"
    replace_rows(make("k string, v int", ("a", 1)), path)
    append_rows(make("k string, v int", ("a", 2), ("b", 3)), path, ["k"])
    assert got(spark.read.parquet(path)) == [("a", 1), ("b", 3)]
    append_rows(make("k string, v int", ("a", 4)), path)
    assert spark.read.parquet(path).count() == 3
    replace_rows(make("k string, v int", ("z", 9)), path)
    assert got(spark.read.parquet(path)) == [("z", 9)]


def test_a_new_path_and_a_table_that_is_read(make, spark, tmp_path):
    path = f"{tmp_path}/concepts"
    append_rows(make("k string, v int", ("a", 1)), path, ["k"])
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError, match="read by"):
        replace_rows(spark.read.parquet(path), path)
