"""What a session leaves in the shared folder."""

import gc
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventpulse.session import cut, work_dir


def files_of(spark):
    return {p for p in Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).rglob("part-*")}


def test_files_of_cut_frames_go_when_no_frame_needs_them(spark):
    before = files_of(spark) if spark.sparkContext.getCheckpointDir() else set()
    kept = cut(spark.range(1000).select((F.col("id") * 2).alias("twice"))).where("twice % 4 = 0")
    of_kept = files_of(spark) - before
    dropped = cut(spark.range(50))
    of_dropped = files_of(spark) - before - of_kept
    assert of_kept and of_dropped and dropped.count() == 50
    del dropped
    for _ in range(60):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)
        if not any(p.exists() for p in of_dropped):
            break
    assert not any(p.exists() for p in of_dropped)
    # A frame made of another still refers to that one's files.
    assert all(p.exists() for p in of_kept) and kept.count() == 500


def test_work_folders_are_new_and_shared(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and all(f.startswith(f"{root}/x-") for f in (first, second))


def test_no_machine_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://somewhere:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Session(), "x")
