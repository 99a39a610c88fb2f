"""Vocabularies on disk, laid out so that a copy of one of them reads nothing of the others.

Terms and paths lie in one folder for each vocabulary and are sorted by node in each file. A path takes its
vocabulary from its node's term once, when it is written. So a constant vocabulary prunes folders when the query is
planned, and a table of wanted ones when it runs; the files' ranges of nodes, and a filter built from
the wanted nodes where these are few beside the paths, keep out what the join would drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from conceptree.functions.tables import restrict
from conceptree.operators.ontology import vocabulary_terms

TERMS = "aui string, code string, tty string, str string, sab string"
PATHS = "aui string, ptr string, sab string"


class VocabularyLayout:
    """The terms and paths of all vocabularies below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, mrconso: DataFrame, mrhier: DataFrame) -> None:
        """Paths of nodes without a term belong to no vocabulary and are left out; a node of two is in both."""
        self._write(mrconso, "terms", TERMS)
        nodes = mrconso.where("aui is not null").select("aui", "sab").distinct()
        self._write(mrhier.select("aui", "ptr").join(nodes, "aui"), "paths", PATHS)

    def _write(self, rows: DataFrame, name: str, schema: str) -> None:
        rows = rows.select(*StructType.fromDDL(schema).names).hint("rebalance", "sab")  # splits large vocabularies
        rows.sortWithinPartitions("sab", "aui").write.partitionBy("sab").parquet(f"{self.path}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def terms(self, vocabulary: str) -> DataFrame:
        return vocabulary_terms(self._read("terms", TERMS), vocabulary)

    def paths(self, vocabulary: str) -> DataFrame:
        """(aui, ptr), without a join."""
        return self._read("paths", PATHS).where(F.col("sab") == vocabulary).select("aui", "ptr")

    def terms_of(self, wanted: DataFrame) -> DataFrame:
        """The terms of the vocabularies in ``wanted`` (sab).

        Only their folders are read if ``wanted`` is a filtered stored table that Spark can broadcast.
        """
        return restrict(self._read("terms", TERMS), "sab", wanted, "sab").select("aui", "sab", "code", "tty", "str")

    def paths_of(self, nodes: DataFrame, vocabulary: str) -> DataFrame:
        """(aui, ptr) of the nodes in ``nodes`` (aui)."""
        return restrict(self.paths(vocabulary), "aui", nodes, "aui")
