"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, ANSI mode (Spark 4 default),
# adaptive execution for runtime re-planning (partition coalescing, skew-join
# splitting, broadcast conversion) and dynamic partition overwrite so that an
# incremental load only replaces the partitions it touches.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # Coalesced shuffle partitions target max(advisory size, total / cores);
    # the default 1 MB floor would collapse small shuffles (e.g. a day's
    # incremental load) into one task that writes every partition file alone.
    # At scale the advisory size dominates and this has no effect.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str = "local[8]",
    app_name: str = "aerolith",
    shuffle_partitions: int = 8,
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``shuffle_partitions`` should be sized so one shuffle partition holds
    roughly 128-256 MB at the target scale; AQE coalesces small ones.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SQL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``;
    without it executors would write where no other host can read, so that is
    an error. Only under a local master, where all tasks share one machine, a
    fresh private folder is created and registered for the rest of the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not _one_machine(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # Core settings cannot change at run time; register the folder with
        # the context so later calls (and RDD checkpoints) find the same one.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aerolith-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the scratch root for one run of ``name``."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def free_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of finished steps when the driver's garbage is collected; this has it done now.

    Twice, as what Python lets go the first time is the JVM's garbage the second.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
