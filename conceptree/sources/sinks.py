"""Writing results. Everything before this is a transform; only these change stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _exists(df: DataFrame, path: str) -> bool:
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def append_rows(new: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Append to a parquet table, which may be new; with ``keys`` only the rows whose keys it lacks."""
    if keys and _exists(new, path):
        stored = new.sparkSession.read.schema(new.schema).parquet(path)
        new = new.join(stored.select(*keys), keys, "left_anti").select(*new.columns)
    new.write.mode("append").parquet(path)


def replace_rows(df: DataFrame, path: str) -> None:
    """Delete every row of the table and write these instead, which must not be read from it."""
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri().getPath()
    if any(spark._jvm.java.net.URI(name).getPath().startswith(whole.rstrip("/") + "/") for name in df.inputFiles()):
        raise ValueError(f"{path} is read by the rows that would replace it")
    df.write.mode("overwrite").parquet(path)
