"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that hold on a laptop and on a cluster alike; sizes (memory, cores,
# shuffle partitions) belong to the deployment.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# A partition of this size sorts in the memory of one core.
PARTITION_BYTES = 256 * 1024**2


def sized_settings(shuffled_bytes: int, cores: int, max_tasks: int = 50_000) -> dict[str, str]:
    """Settings for a job that shuffles about ``shuffled_bytes`` on ``cores`` cores.

    With more than ``max_tasks`` on both sides of a shuffle, the blocks that pass
    between them get too small to fetch; larger partitions that spill are cheaper.

    The adaptive planner joins partitions that turn out small but never splits
    an ordinary shuffle, so the initial number has to fit the data: the default
    of 200 would make half a terabyte per task out of 100 TB.
    """
    partitions = min(max_tasks, -(-shuffled_bytes // PARTITION_BYTES))
    split = max(PARTITION_BYTES // 2, shuffled_bytes // max_tasks)
    return {
        "spark.sql.shuffle.partitions": str(max(2 * cores, partitions)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{PARTITION_BYTES // 2}b",
        "spark.sql.files.maxPartitionBytes": f"{split}b",
    }


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a path; 0 if there is none. Only the listing is read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(folder).getLength() if fs.exists(folder) else 0


def local_session(
    cores: int | str = "*", app: str = "areafacts", memory: str = "8g", settings: dict[str, str] | None = None
) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
