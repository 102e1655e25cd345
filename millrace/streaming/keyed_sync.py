"""An index kept in step with a change feed by state per document.

The feed may publish a version again, late and in any order. The stream's state holds, for every document, the newest
version taken in and its digest; a row that says something newer, or something else about the newest version, goes to the
index log under the number of the batch that brought it. So the last row by number is the current one, whatever
versions came again, and a compacted log needs only rows with higher numbers.

The state is a streaming aggregate, so no document costs a call of Python. An aggregate hands out every document that a
batch speaks of; those of which the log says the same already are dropped by a join with its ids and digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.changes import BEFORE_UPDATE, DELETE
from millrace.operators.joins import anti_join
from millrace.operators.vectors import Embedder, embed_text
from millrace.streaming.index_sync import KEY, content_digest
from millrace.streaming.medallion import stream_table
from millrace.streaming.run import drain

NUMBER = "sequence"
LOG_SCHEMA = (
    f"{KEY} string, commit_version bigint, deleted boolean, original_url string, content string, content_digest string, "
    f"embedding array<float>, {NUMBER} bigint"
)


def _said(digest: Column) -> Column:
    return F.concat_ws("/", digest, F.col("original_url")).alias("said")


def _digests(feed: DataFrame, *more: Column | str) -> DataFrame:
    """What each version in the feed says of each document; a deletion has the digest 'deleted'."""
    digest = F.when(F.col("change_type") == DELETE, "deleted").otherwise(content_digest(F.coalesce("content", F.lit(""))))
    rows = feed.filter(F.col("change_type") != BEFORE_UPDATE)
    return rows.select(F.col(KEY).cast("string").alias(KEY), F.col("commit_version").cast("bigint").alias("commit_version"), _said(digest), *more)


def _newest(digests: DataFrame) -> DataFrame:
    """State per document: of the newest version what came last, by the time of the batch, which Spark logs with it, then of the file."""
    row = F.struct("commit_version", F.current_timestamp().alias("taken_in"), "published", "said")
    newest = digests.select(KEY, row.alias("row")).groupBy(KEY).agg(F.max("row").alias("row"))
    return newest.select(KEY, "row.commit_version", "row.said")


def _known(log: DataFrame) -> DataFrame:
    """What the last row by number says of each document."""
    said = _said(F.when(F.col("deleted"), "deleted").otherwise(F.col("content_digest")))
    return _last(log.select(KEY, "commit_version", said, NUMBER)).drop(NUMBER)


def run_keyed_sync(
    spark: SparkSession, feed: str, log_path: str, checkpoint: str, embed: Embedder = embed_text, files_per_batch: int = 10_000
) -> None:
    """Take in what is new in the change feed, also versions that were published again.

    Only ids, versions and digests pass the state; the texts of what has changed are then read from the feed. Each
    batch writes ``log/sequence=<id>``; a repeated batch overwrites it. A row that the feed has replaced meanwhile is left for
    the batch that brings its replacement.
    """
    stream = stream_table(spark, feed, files_per_batch)
    touched = _newest(_digests(stream, F.col("_metadata.file_modification_time").alias("published")))
    same = [KEY, "commit_version", "said"]

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        changed = batch
        if batch_id:  # a repeated batch doesn't see its own rows
            log = session.read.schema(LOG_SCHEMA).parquet(log_path).filter(F.col(NUMBER) < batch_id)
            changed = batch.join(_known(log), same, "left_anti")
        whole = _digests(session.read.parquet(feed), (F.col("change_type") == DELETE).alias("deleted"), "original_url", "content")
        found = changed.join(whole, same)
        kept = found.withColumn("content", F.when(F.col("deleted"), "").otherwise(F.coalesce("content", F.lit(""))))
        embedded = embed(kept.withColumn("content_digest", content_digest(F.col("content"))), "content")
        rows = embedded.select(
            KEY, "commit_version", "deleted", "original_url", F.when(~F.col("deleted"), F.col("content")).alias("content"), "content_digest",
            F.when(~F.col("deleted"), F.col("embedding")).alias("embedding"),
        )
        rows.write.mode("overwrite").parquet(f"{log_path}/{NUMBER}={batch_id}")

    writer = touched.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    drain(writer.trigger(availableNow=True).start())


def keyed_index(spark: SparkSession, log_path: str, base: str | None = None) -> DataFrame:
    """The current rows: the last by number per document, without deleted ones. With ``base``, a compacted log, only newer rows are ranked."""
    log = spark.read.schema(LOG_SCHEMA).parquet(log_path)
    if base is None:
        return _last(log).filter("not deleted")
    stored = spark.read.schema(LOG_SCHEMA).parquet(base)
    upto = stored.agg(F.max(NUMBER)).first()[0]
    newer = _last(log if upto is None else log.filter(F.col(NUMBER) > upto))
    return anti_join(stored, newer, KEY).unionByName(newer).filter("not deleted")


def _last(log: DataFrame) -> DataFrame:
    """The rank filter also runs before the shuffle, so a document with very many rows sends one per task."""
    newest = Window.partitionBy(KEY).orderBy(F.desc(NUMBER))
    return log.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def compact_keyed_index(spark: SparkSession, log_path: str, target: str) -> None:
    """Write the last row of every document, deletions too, as a base for :func:`keyed_index`."""
    _last(spark.read.schema(LOG_SCHEMA).parquet(log_path)).write.parquet(target)
