"""Session settings shared by batch jobs, streams and tests."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Timestamps carry no zone in the data model; UTC keeps the casts between
# timestamp and timestamp_ntz loss-free (no daylight-saving holes).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A folder a task (10,000 tasks at most) is what lists a table of one folder per file otherwise.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job relies on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the local benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rillcast")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


# Folders made for sessions on one machine that name none, by application.
_own_folders: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage and stream state.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    on one machine (tests) is a temporary folder made, one per application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="rillcast-")
    return _own_folders[context.applicationId]
