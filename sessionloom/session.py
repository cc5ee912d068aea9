"""A session with the settings the operators assume."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

#: UTC so that dates don't depend on the host; adaptive execution for skewed joins and small partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(app: str = "sessionloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SETTINGS, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where that is unset and all runs on this machine, one of our own."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        context.setCheckpointDir(found)
    return found.rstrip("/")


#: Folders of the shared store that this driver has written for its queries.
_mine: list[str] = []


def fresh(spark: SparkSession, tag: str) -> str:
    """A new folder of the shared store, which `sweep` removes, at the latest when the driver ends."""
    if not _mine:
        atexit.register(sweep)
    _mine.append(f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}")
    return _mine[-1]


def sweep() -> None:
    """Remove what queries have written to the shared store so far; for when their results are read or written elsewhere."""
    jvm, context = SparkContext._jvm, SparkContext._active_spark_context
    while _mine and jvm is not None:
        place = jvm.org.apache.hadoop.fs.Path(_mine.pop())
        conf = context._jsc.hadoopConfiguration() if context is not None and context._jsc is not None else jvm.org.apache.hadoop.conf.Configuration()
        place.getFileSystem(conf).delete(place, True)


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read again: rows don't change when a lost executor's work is repeated, and lineage ends."""
    path = fresh(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def table(spark: SparkSession, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")
