"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the text contracts: space, and tab to carriage return. Fixed value.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or, where that is unset and all runs on this machine, one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: What the open scratch blocks have written, the innermost last.
_open: list[list[str]] = []


def fresh_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read again: lineage ends, and a lost executor costs no more than a reread."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession):
    """Removes at its end what was written inside it, except the tables given to the function it yields; those count as written where the block stands."""
    mine: list[str] = []
    kept: list[str] = []

    def keep(df: DataFrame, tag: str) -> DataFrame:
        out = cut(df, tag)
        kept.append(mine[-1])
        return out

    _open.append(mine)
    try:
        yield keep
    finally:
        _open.remove(mine)
        for path in mine:
            if path not in kept:
                removed(spark, path)
        if _open:
            _open[-1].extend(kept)


def free_name(wanted: str, taken: list[str]) -> str:
    """A column name that isn't taken, whatever the case of its letters."""
    low = {t.lower() for t in taken}
    while wanted.lower() in low:
        wanted += "_"
    return wanted


def own_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Only the named columns, cast, so that no further column of the input can clash with ours. wanted: name -> type."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in wanted.items()])


def tokenizer_bytes(name_or_path: str) -> bytes:
    """A public vocabulary file by path, or by its name in the installed package of public tokenizers."""
    import os

    if not os.path.exists(name_or_path):
        import public_tokenizers

        name_or_path = public_tokenizers.path(name_or_path)
    with open(name_or_path, "rb") as f:
        return f.read()


def text_slices(texts: list, most_chars: int = 1_000_000):
    """Runs (start, end) of a batch with about most_chars characters each, a longer text alone; so working memory follows the longest text, not the batch."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and total + n > most_chars:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, len(texts)


def release() -> None:
    """Hand memory that is free inside this Python worker back to the machine, since workers outlive their tasks."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run, *forget):
    """The batch function run, after which forget's functions drop what the worker keeps, and free memory is released."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            for f in forget:
                f()
            release()

    return wrapped


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Session settings that hold inside the block; what runs there must be an action."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
