"""Session defaults and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def build_session(app: str = "conceptree", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by all executors.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may go
    without, as there the driver's disk is the executors' disk.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _local_folders:
            _local_folders[app] = "file://" + tempfile.mkdtemp(prefix="conceptree-")
        shared = _local_folders[app]
    return f"{shared.rstrip('/')}/conceptree-{app}"


def new_table_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, survives the loss of executors, and gives the optimizer the
    table's true size, by which it decides on its own whether to broadcast it.
    """
    path = new_table_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, *builds: Callable[[], DataFrame]) -> list[DataFrame]:
    """Run builds that don't depend on each other side by side.

    Each stores tables as it goes. The many short jobs of a hierarchy then fill in beside
    one long job over the facts instead of waiting for it.
    """
    target = inheritable_thread_target(spark)
    with ThreadPoolExecutor(min(len(builds), 8)) as pool:
        return [f.result() for f in [pool.submit(target(build)) for build in builds]]


def clean_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
