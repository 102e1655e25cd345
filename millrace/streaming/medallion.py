"""Bronze, silver and gold: ingest as is, drop bad rows, aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.aggregates import average_of_totals, monthly_totals
from millrace.operators.quality import Constraint, count_violations, drop_violations, observe_violations
from millrace.sources.csv import stream_csv_directory
from millrace.streaming.run import FILES_PER_BATCH, append_table, drain, drain_observed, each_batch


def stream_table(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """What is appended to a table, as a stream. The table's own schema is used."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_bronze(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    bronze: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Append the CSV files that are new."""
    drain(append_table(stream_csv_directory(spark, folder, schema, files_per_batch), bronze, checkpoint))


def run_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    checkpoint: str,
    constraints: Sequence[Constraint],
    files_per_batch: int = FILES_PER_BATCH,
) -> dict[str, int]:
    """Append the new bronze rows that satisfy all constraints; returns the violations per constraint among the new rows.

    The rows are counted while they pass by on their way to silver, so bronze is read once. For counts that outlive
    the run, and for those of a run that was stopped, there is :func:`run_violation_log`.
    """
    observed = observe_violations(stream_table(spark, bronze, files_per_batch), constraints, "violations")
    counts = drain_observed(append_table(drop_violations(observed, constraints), silver, checkpoint), "violations")
    return {c.name: sum(batch[c.name] for batch in counts.values()) for c in constraints}


def run_violation_log(
    spark: SparkSession,
    bronze: str,
    log: str,
    checkpoint: str,
    constraints: Sequence[Constraint],
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Write each batch's violation counts to ``log/batch=<id>``, reading the constrained columns only."""

    def record(batch: DataFrame, batch_id: int) -> None:
        count_violations(batch, constraints).write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    drain(each_batch(stream_table(spark, bronze, files_per_batch), checkpoint, record))


def total_violations(spark: SparkSession, log: str) -> DataFrame:
    """Violations per constraint over all batches."""
    return spark.read.parquet(log).groupBy("constraint_name").agg(F.sum("violations").alias("violations"))


def run_totals_log(
    spark: SparkSession,
    silver: str,
    log: str,
    checkpoint: str,
    moment: str,
    area: str,
    value: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Write each batch's monthly totals to ``log/batch=<id>``.

    The gold table is then an aggregate over the few rows of the log: a refresh reads what is new in
    silver instead of all of it.
    """

    def record(batch: DataFrame, batch_id: int) -> None:
        totals = monthly_totals(batch, moment, area, value)
        totals.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    drain(each_batch(stream_table(spark, silver, files_per_batch), checkpoint, record))


def run_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    checkpoint: str,
    moment: str,
    area: str,
    value: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Keep monthly totals as the state of a stream; after each batch all groups are written to ``gold/batch=<id>``.

    The state holds a row per month and area, partitioned by them, and is stored with the checkpoint; a batch reads what
    is new in silver and changes the groups it touches. A repeated batch overwrites its folder with the same rows.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{gold}/batch={batch_id}")

    totals = monthly_totals(stream_table(spark, silver, files_per_batch), moment, area, value)
    writer = totals.writeStream.outputMode("complete").foreachBatch(publish)
    drain(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def current_gold(spark: SparkSession, gold: str) -> DataFrame:
    """Monthly averages as of the last batch of :func:`run_gold`."""
    stored = spark.read.parquet(gold)
    last = stored.agg(F.max("batch")).first()[0]  # from the folders' names
    return average_of_totals(stored.filter(F.col("batch") == F.lit(last)))


def gold_from_totals(spark: SparkSession, log: str) -> DataFrame:
    """Monthly averages over all batches so far."""
    return average_of_totals(spark.read.parquet(log))
