"""The session settings that all jobs assume."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


#: Rows of a few numbers that may go to every task, some 150 MB of them.
FEW = 2_000_000


def session(name: str = "matchloom", **settings: str) -> SparkSession:
    return SparkSession.builder.appName(name).config(map=SETTINGS | settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: dict[str, str] = {}  # by application, where the cluster names no shared folder


def folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors share, below ``spark.checkpoint.dir``.
    Where that isn't set a temporary folder is taken, on a local master only."""
    shared, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not shared:
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = tempfile.mkdtemp(prefix="spark-matchloom-")
        shared = _own[context.applicationId]
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to a shared folder and read again, so that it is worked out once and
    executors that are lost take nothing with them."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, jobs: list[Callable[[], object]]) -> list:
    """Runs a few independent jobs at a time, so that the tasks of one fill the slots that
    another leaves idle; the first failure is raised once all have ended."""
    with ThreadPoolExecutor(max(1, min(8, len(jobs)))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [r.result() for r in running]
