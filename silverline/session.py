"""Session factory.

Cluster sessions come from the platform; this builder is for local runs,
tests and the benchmark. It pins the settings the library's results depend on
(UTC, ANSI) and the ones its plans are designed around (AQE with partition
coalescing and skew-join splitting).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

# Settings every silverline plan assumes. Shuffle partition count is sized by
# the caller: ~cores locally, ~(shuffle bytes / 128 MiB) on a cluster, and AQE
# coalesces the small ones at runtime.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Every Column call would otherwise ask the JVM for a setting and note its
    # Python call site: several calls a column, seconds for a contract of rules.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "silverline",
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    master = master or os.environ.get("SILVERLINE_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(
        shuffle_partitions or os.environ.get("SILVERLINE_SHUFFLE_PARTITIONS", 8)
    )
    if master.startswith("local"):
        # Local mode: the driver JVM is the only executor. The throughput
        # collector measured ~15% faster and far steadier than G1 on these
        # batch plans. On a cluster, JVM options are the platform's call.
        conf.setdefault("spark.driver.memory", os.environ.get("SILVERLINE_DRIVER_MEMORY", "8g"))
        conf.setdefault("spark.driver.extraJavaOptions", "-XX:+UseParallelGC")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - older / connect sessions
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder.

    Local sessions without one get a temporary folder (driver and executor are
    one process there). On any other master a missing setting is an error: a
    machine-local folder would be invisible to the other executors."""
    existing = checkpoint_dir(spark)
    if existing:
        return existing
    master = spark.conf.get("spark.master", "")
    if not is_single_process(master):
        raise RuntimeError(
            f"spark.checkpoint.dir is not set and the master is {master!r}: "
            "name a folder that the driver and all executors share"
        )
    local = tempfile.mkdtemp(prefix="silverline-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session within the block; those of before are put back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager:
    """Shuffle files of a query go when it ends, not when the driver's garbage is collected."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def is_single_process(master: str) -> bool:
    """True for `local`, `local[n]`, `local[n,f]`; false for `local-cluster[...]`
    and every real cluster."""
    return master == "local" or master.startswith("local[")
