"""Session settings this package expects; all can be overridden by the caller."""

from pyspark.sql import SparkSession

# Partition sizes are decided at run time: start with many small shuffle partitions and let
# adaptive execution merge them to the advisory size, split skewed join partitions and rebalance writes.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Lost executors cost retries, not the run.
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "10",
}

MEGABYTE = 1 << 20
MAX_SCAN_TASKS = 100_000
MAX_SHUFFLE_PARTITIONS = 40_000


def sized_settings(input_bytes: int, max_scan_tasks: int = MAX_SCAN_TASKS,
                   max_shuffle_partitions: int = MAX_SHUFFLE_PARTITIONS) -> dict[str, str]:
    """Scan split size and shuffle partitions for an input size.

    Splits of 256 MB and shuffle partitions of 256 MB, until their number would make the shuffle's blocks
    (tasks x partitions) too many; from there the sizes grow: at 100 TB to 1 GB and 2.5 GB, which spill. A cluster
    whose shuffle service bears more blocks, or that serves them merged, can raise both numbers.
    """
    split = max(256 * MEGABYTE, -(-input_bytes // max_scan_tasks))
    partitions = min(max_shuffle_partitions, max(200, -(-input_bytes // (256 * MEGABYTE))))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def session(app_name: str = "playtally", input_bytes: int | None = None, **settings: str) -> SparkSession:
    """A session with CLUSTER_SETTINGS, sized for `input_bytes`; keyword settings use `__` for dots and win."""
    chosen = dict(CLUSTER_SETTINGS)
    if input_bytes is not None:
        chosen.update(sized_settings(input_bytes))
    chosen.update({name.replace("__", "."): value for name, value in settings.items()})
    builder = SparkSession.builder.appName(app_name)
    for name, value in chosen.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
