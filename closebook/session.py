"""Session settings the jobs rely on. Only runtime SQL settings are touched; cluster sizing stays with the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # A partition value such as 2024-01-01 must come back as text, not as a date.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A moment is the same date on every cluster.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join on one column must not make a later aggregate on more columns reuse its
    # partitioning: one hot join key would then be aggregated by a single task.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # A join whose build side is this small in every task hashes it instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Failed casts are handled by try_cast, everything else should fail loudly.
    "spark.sql.ansi.enabled": "true",
}


# Bytes that a shuffle task should get at first; adaptive execution merges smaller ones. Columnar files hold about
# EXPANSION times their size in rows. MOST_TASKS, a session setting, is how many a driver is trusted to track.
BYTES_PER_SHUFFLE_TASK = 128 * 1024 * 1024
EXPANSION = 3
MOST_TASKS = "spark.closebook.shuffle.maxTasks"
MOST_TASKS_DEFAULT = 1_000_000
FIRST_TASKS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SIZED = "spark.closebook.shuffle.sized"


def configure(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply the settings; with ``input_bytes`` also size the shuffles for that much columnar input."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    most = int(spark.conf.get(MOST_TASKS, str(MOST_TASKS_DEFAULT)))
    tasks = min(input_bytes * EXPANSION // BYTES_PER_SHUFFLE_TASK, most)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(FIRST_TASKS, str(tasks))
        spark.conf.set(SIZED, str(tasks))
    elif spark.conf.get(SIZED, None):
        # A larger job's number is not a later, smaller one's.
        if spark.conf.get(FIRST_TASKS, None) == spark.conf.get(SIZED):
            spark.conf.unset(FIRST_TASKS)
        spark.conf.unset(SIZED)
    return spark


def size_shuffles(spark: SparkSession, *sources: DataFrame) -> None:
    """Size the shuffles of a job for the files its sources read, as Catalyst knows them; nothing is run."""
    sizes = (int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in sources)
    # An estimate may be the product of two tables' sizes; no job reads more than this.
    configure(spark, min(sum(sizes), 1 << 60))
