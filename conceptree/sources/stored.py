"""Tables that change whole versions at a time.

A version is a numbered list of folders, each with the rows of one bucket of the key. New rows are
written beside the old ones first; a version exists once its list is moved into place, which fails
if another writer was there before. So a change that breaks off leaves the table as it was, and of
two appends at once the later one starts again from the other's version.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from conceptree.functions.tables import update_from

_DIGITS = 12
_RETRIES = 10


class VersionTaken(Exception):
    """Another writer made the version first."""


class StoredTable:
    """A table below ``path``; rows of one ``key`` lie in one of ``buckets`` buckets."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, buckets: int = 16):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, key, buckets
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(self._conf)

    def _list(self, version: int):
        return self._path(f"{self.path}/versions/{version:0{_DIGITS}d}")

    def version(self) -> int:
        """The newest version; 0 for a table that is not there yet."""
        folder = self._path(f"{self.path}/versions")
        if not self._fs.exists(folder):
            return 0
        return max((int(f.getPath().getName()) for f in self._fs.listStatus(folder) if f.getPath().getName().isdigit()), default=0)

    def folders(self, version: int | None = None) -> list[tuple[int, str]]:
        """(bucket, folder) of the newest or the given version."""
        version = self.version() if version is None else version
        if not version:
            return []
        lines = self.spark.read.text(str(self._list(version).toString())).collect()  # one for each bucket and append
        return sorted((int(bucket), folder) for bucket, folder in (r["value"].split("\t") for r in lines if r["value"]))

    def _read(self, folders: list[tuple[int, str]]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{folder}" for _, folder in folders])

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.folders(version))

    def _bucket(self, column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(self.buckets)).cast("int")

    def _stage(self, rows: DataFrame) -> list[tuple[int, str]]:
        """Write rows where no version lists them yet."""
        name = f"rows/{uuid.uuid4().hex}"
        dealt = rows.select(*self.schema.names).withColumn("_bucket", self._bucket(self.key)).hint("rebalance", "_bucket")
        dealt.write.partitionBy("_bucket").parquet(f"{self.path}/{name}")
        entries = [f.getPath().getName() for f in self._fs.listStatus(self._path(f"{self.path}/{name}"))]
        return [(int(e.split("=")[1]), f"{name}/{e}") for e in entries if e.startswith("_bucket=")]

    def _commit(self, version: int, folders: list[tuple[int, str]]) -> None:
        jvm = self.spark._jvm
        text = "".join(f"{bucket}\t{folder}\n" for bucket, folder in folders).encode()
        draft = self._path(f"{self.path}/drafts/{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(text))
        out.close()
        self._fs.mkdirs(self._path(f"{self.path}/versions"))
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        target = self._list(version)
        try:
            files.rename(self._fs.makeQualified(draft), self._fs.makeQualified(target), none)
        except Exception as error:
            if self._fs.exists(target):
                raise VersionTaken(version) from error
            raise

    def _change(self, change: Callable[[list[tuple[int, str]]], list[tuple[int, str]]]) -> int:
        for _ in range(_RETRIES):
            version = self.version()
            try:
                self._commit(version + 1, change(self.folders(version)))
                return version + 1
            except VersionTaken:
                continue
        raise VersionTaken(f"{self.path}: other writers came first {_RETRIES} times")

    def replace(self, rows: DataFrame) -> int:
        """All rows anew, which may be read from the table itself; the new version's number."""
        staged = self._stage(rows)
        return self._change(lambda _: staged)

    def append(self, rows: DataFrame, keys: list[str] | None = None) -> int:
        """More rows; with ``keys`` one of those whose keys the table lacks."""

        def more(folders: list[tuple[int, str]]) -> list[tuple[int, str]]:
            new = rows
            if keys:
                new = rows.dropDuplicates(keys).join(self._read(folders).select(*keys), keys, "left_anti")
            return sorted(folders + self._stage(new))

        return self._change(more)

    def update(self, source: DataFrame, key: str, value: str, target: str, only: Column | None = None) -> int:
        """Set ``target`` from the row of ``source`` with the table's key; only buckets with a match are written anew."""

        def changed(folders: list[tuple[int, str]]) -> list[tuple[int, str]]:
            keys = source.where(F.col(key).isNotNull()).select(F.col(key).alias(self.key)).distinct()
            matched = self._read(folders).join(keys, self.key, "left_semi")
            hit = {r["b"] for r in matched.select(self._bucket(self.key).alias("b")).distinct().collect()}  # at most the buckets
            if not hit:
                return folders
            rows = self._read([f for f in folders if f[0] in hit])
            return sorted([f for f in folders if f[0] not in hit] + self._stage(update_from(rows, self.key, source, key, value, target, only)))

        return self._change(changed)
