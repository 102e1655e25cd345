"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that matter at scale. Sizes that depend on the cluster (executor memory, number of
# shuffle partitions) are left to the caller: the adaptive planner coalesces small shuffle
# partitions and splits skewed ones, so the shuffle partition count can be set generously.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # fewer, longer scan tasks; shuffle partitions follow the advisory size above
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str = "millrace",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with :data:`SETTINGS`; ``master=None`` leaves the choice to the launcher."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Listing many single files starts a task per file unless told otherwise.
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(listing_tasks(spark)))
    return spark


def listing_tasks(spark: SparkSession) -> int:
    """Tasks that list files, a few per core."""
    return min(10_000, max(64, 4 * spark.sparkContext.defaultParallelism))


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A sibling session on the same context with some settings changed.

    Settings are read when a plan is made, which is after the function that built the DataFrame has
    returned. A sibling session keeps them for exactly the frames made from it and leaves the
    caller's session alone.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    sibling.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in settings.items():
        sibling.conf.set(key, value)
    return sibling
