"""Session settings and the shared work folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}

# Arrow allocates by the C library; blocks from 2 MB on are mapped by themselves, and 8 MB of free memory stay at most.
LEAN_WORKERS = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_MMAP_THRESHOLD_": str(2 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(8 << 20),
}


def local_session(
    app: str = "eventpulse", cores: str = "*", shuffle_partitions: int = 8, extra: dict[str, str] | None = None
) -> SparkSession:
    """A session for tests and the bench. On a cluster, pass ``SETTINGS`` to spark-submit instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def share_package(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from where it lies.

    On a cluster the package is shipped with ``--py-files`` instead.
    """
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def lean_workers(spark: SparkSession) -> None:
    """Has Python workers give freed memory back to the system, at some cost in time, and share the package.

    By default Arrow's pool and the C library keep what a worker once used, which adds up where
    operators follow each other. Frames made before still use workers of the earlier environment,
    so this comes first. What the session's environment says already is left as it is.
    """
    share_package(spark)
    for key, value in LEAN_WORKERS.items():
        spark.sparkContext.environment.setdefault(key, value)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path under the session's ``spark.checkpoint.dir``.

    Every executor must see it, so a machine-local folder is only used when the
    setting is absent and the session itself is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = _local_folder()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="eventpulse-", ignore_cleanup_errors=True)


def _local_folder() -> str:
    """A folder for this process, removed when it ends."""
    return _folder().name


def cut(df: DataFrame) -> DataFrame:
    """The rows, computed now and kept by Spark's reliable checkpoint in the shared folder.

    With ``SETTINGS``, Spark removes the files once no frame refers to them any more.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(df.sparkSession, "cut"))
    return df.checkpoint()
