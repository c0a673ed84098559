"""Session settings, the shared work folder and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Hashable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on: UTC time zone, and adaptive execution
# with skewed join partitions split even where that costs one more shuffle.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_dirs: dict[str, str] = {}
_local_lock = threading.Lock()

# Steps of one `together` that run at the same time: enough to hide planning, few enough for the driver's memory.
AT_ONCE = 4

K = TypeVar("K", bound=Hashable)
V = TypeVar("V")


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: `spark.checkpoint.dir` of the session.

    Only a local master may go without the setting; it then gets a folder of
    its own, since its executors share the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    with _local_lock:
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="forgelake-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    The rows are computed once however often they are used, survive the loss of
    any executor, and come with a measured size for the join strategies.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, steps: dict[K, Callable[[], V]]) -> dict[K, V]:
    """Run steps that do not depend on each other at the same time; the result of each under its name.

    A batch is hundreds of small jobs, most of whose time is planning and waiting. When a step
    fails its error is raised, after the steps that had started are through.
    """
    if len(steps) < 2:
        return {name: step() for name, step in steps.items()}
    with ThreadPoolExecutor(AT_ONCE) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(step)) for name, step in steps.items()}
        try:
            return {name: found.result() for name, found in running.items()}
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise


def cut_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """`cut_lineage` of several frames that do not depend on each other."""
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    return together(spark, {name: lambda df=df, name=name: cut_lineage(df, name) for name, df in frames.items()})
