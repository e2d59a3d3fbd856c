"""Session construction and the shared scratch folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Sizes (shuffle partitions, file split size)
# are left to AQE and to the cluster's own defaults unless the caller passes
# them: AQE coalesces small shuffles and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dates are stamped from an explicit run date, never from the clock, so
    # the session zone only matters for timestamp rendering; pin it.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A generated method larger than the JIT's 8000-byte limit is never
    # compiled and runs interpreted, slower than Spark's non-fused fallback;
    # make Spark take the fallback for such stages (wide clean-up projections).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "terrace",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build (or fetch) a session with the pipeline's baseline settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and visible to every executor.
    Only when it is unset and the master is local (tests) do we pick a fresh
    local folder and register it, so later ``checkpoint()`` calls land there
    too; on a cluster an unset folder is an error, since a local one would be
    seen by one machine only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        root = tempfile.mkdtemp(prefix="terrace-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - core confs may be read-only at run time
            pass
    return root


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A new, unique folder under the shared checkpoint root.

    Every call gets its own folder so no run ever clears or overwrites
    another run's files.
    """
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file://", "").replace("file:", ""), exist_ok=True)
    return path


# Stored (compressed parquet) bytes per shuffle partition. Decoded and
# projected rows in a shuffle are a few times larger, which lands near the
# 256-512 MB per task that keeps sorts and hash tables in executor memory.
STORED_BYTES_PER_PARTITION = 128 * 1024 * 1024
# The same for rows of many short texts, which are 10 to 20 times larger in a sort.
PACKED_BYTES_PER_PARTITION = 16 * 1024 * 1024


def size_shuffle_partitions(
    spark: SparkSession,
    input_bytes: int,
    bytes_per_partition: int = STORED_BYTES_PER_PARTITION,
) -> int:
    """Set ``spark.sql.shuffle.partitions`` for the next jobs from the size of
    their input: at least one per core, one per ``bytes_per_partition``.

    AQE coalesces partitions that turn out small but never splits large
    ones (outside skewed joins), so the starting count must be big enough
    for the data; the default of 200 is not at warehouse scale.
    """
    cores = spark.sparkContext.defaultParallelism
    n = max(cores, math.ceil(input_bytes / bytes_per_partition))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
