"""Session settings every job relies on, and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings the marts depend on for correct results (not tuning knobs):
# event times are instants interpreted in UTC, and casts fail loudly.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Runtime re-planning: coalesce small shuffle partitions, split skewed join
# partitions (a NAT / proxy IP can own a large share of sessions), and turn
# sort-merge joins into broadcast joins only when the measured side is small.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    # coalesced partitions stop at this size, and with them the memory of a task: the
    # aggregates' rows take some 15 times their shuffled bytes
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    # never broadcast on a static size estimate (estimates are not bounds);
    # AQE turns a join into a broadcast only after measuring the small side
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings (safe to call repeatedly)."""
    for key, value in {**REQUIRED_CONF, **ADAPTIVE_CONF}.items():
        if spark.conf.get(key, None) != value:
            try:
                spark.conf.set(key, value)
            except Exception:  # noqa: BLE001 - a static conf fixed by the deployment
                if key in REQUIRED_CONF:
                    raise
    return spark


@contextlib.contextmanager
def partitioned_write(spark: SparkSession):
    """Settings for the duration of a partitioned write: a small load still
    keeps a few write tasks (a write of many small days is not serialised
    into one task); large writes are sized by the advisory partition size."""
    key, value = "spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB"
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield spark
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def build_session(master: str = "local[*]", app: str = "riskmesh",
                  shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own builder."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("RISKMESH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.maxMetadataStringLength", "1000")  # plans name whole partition filters
    )
    for key, value in {**REQUIRED_CONF, **ADAPTIVE_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (once a Spark context), so that
    executors need no copy of the repository."""
    context = spark.sparkContext
    if getattr(context, "_riskmesh_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="riskmesh-ship-"), "riskmesh_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(archive)
    context._riskmesh_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to a shared file system; without it a
    job is refused there. A local session (tests) may leave it unset and gets a
    scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if spark.conf.get("spark.master", "").split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="riskmesh-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current
