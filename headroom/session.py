"""Session helpers: a local session for tests/bench and the shared output folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "headroom") -> SparkSession:
    """Local session for tests and benchmarks (UI off, AQE on, UTC)."""
    return (SparkSession.builder.master(f"local[{cores}]").appName(app)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.python.sql.dataFrameDebugging.enabled", "false")
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", "8g")
            .getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session; only a local-mode session without the setting gets a folder of its
    own (tests). A cluster session without it is an error: a machine-local folder would not be
    visible to other executors and would not survive their loss.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    d = tempfile.mkdtemp(prefix="headroom-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query go as it ends, not when the driver's garbage collector gets to them.

    For jobs that write each stage and read it again: no later query uses an earlier one's shuffles. A
    DataFrame of this session that is run twice in the meantime shuffles twice.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
