"""Session settings: what a cluster run should set, and a local session for tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes and splits shuffle partitions at run time; the high
# initial number leaves it small pieces to combine. Joins of item or order
# rows rely on the skew split, so keep it on.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine, without the web page."""
    partitions = str(cpus) if isinstance(cpus, int) else "8"
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallymart")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        # Recording the Python line of every column doubles the cost of building a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
