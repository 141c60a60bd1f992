"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches; on a cluster use the session that is given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("acreline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session, which has no other machines, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="acreline-")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that no other run uses."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Tree learners cut their lineage by checkpoints; give them a place when none is set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


@contextmanager
def beside(spark: SparkSession, step: Callable[[], Any]) -> Iterator[Callable[[], Any]]:
    """Runs a step that starts Spark jobs beside the block, which receives a function that waits for its result (or
    raises its error). The step is over when the block is left."""
    with ThreadPool(1) as pool:
        running = pool.apply_async(inheritable_thread_target(spark)(step))
        try:
            yield running.get
        finally:
            running.wait()
