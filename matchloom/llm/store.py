"""Tables written in the middle of a job, and the input tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_folders: list[str] = []  # of the scratch blocks that are open, the innermost last
_own: dict[str, str] = {}  # by application, where the cluster names no folder


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Where nothing is named, a temporary
    folder is taken, on a local master only: executors on other machines would not see it.
    """
    named, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not named:
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = tempfile.mkdtemp(prefix="spark-matchloom-")
        named = _own[context.applicationId]
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_folders[-1] if _folders else shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df``, written to the shared folder and read again: its lineage ends here, and an
    executor that is lost takes nothing with it."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``written`` that nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, df.stored_at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written in the block are deleted at its end, so its result has to be written
    elsewhere (``path`` of ``written``) before that."""
    _folders.append(f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        _delete(spark, _folders.pop())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
