"""Keep an embedding index in step with a document table.

The index is a log: each sync adds rows for the documents that changed, and the current index is the
latest row per document that is not a deletion. A sync therefore writes as much as has changed, not
as much as the index holds, and embeds only new or changed texts. ``compact_index`` rewrites the log
to its current rows now and then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.changes import BEFORE_UPDATE, DELETE, INSERT, changed_keys, snapshot_changes
from millrace.operators.joins import anti_join
from millrace.operators.tables import replace_table
from millrace.operators.vectors import Embedder, embed_text
from millrace.streaming.medallion import stream_table
from millrace.streaming.run import append_table, drain
from millrace.workspace import fresh_dir

KEY = "document_id"
LOG_COLUMNS = (KEY, "commit_version", "arrived", "change_type", "original_url", "content", "content_digest", "embedding")


def content_digest(content: Column) -> Column:
    """SHA-256 of a text; a missing text has a digest of its own."""
    return F.coalesce(F.sha2(content, 256), F.lit("none"))


def current_index(log: DataFrame, compacted: int | None = None) -> DataFrame:
    """Latest row per document, without deleted ones: of the newest version, the one that arrived last.

    The rank filter also runs before the shuffle, so a document with very many versions sends one
    row per task. When the log was compacted up to a version, rows up to there are one per document:
    only newer rows are ranked, and compacted rows stay where they are unless a newer row replaces
    them.
    """
    if compacted is not None:
        newer = log.filter(F.col("commit_version") > compacted)
        base = anti_join(log.filter(F.col("commit_version") <= compacted), newer, KEY)
        return base.drop("change_type", "arrived").unionByName(current_index(newer))
    newest = Window.partitionBy(KEY).orderBy(*[F.desc(c) for c in ("commit_version", "arrived") if c in log.columns])
    ranked = log.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1)
    return ranked.filter(F.col("change_type") != DELETE).drop("_rank", "change_type", "arrived")


def _log_rows(changes: DataFrame, embed: Embedder) -> DataFrame:
    """Change rows to log rows, with the document's columns and when they were taken in.

    A deletion has no content and no embedding; ``embed`` sees an empty text for it.
    """
    if "original_url" not in changes.columns:
        changes = changes.withColumn("original_url", F.lit(None).cast("string"))
    deleted = F.col("change_type") == DELETE
    kept = changes.filter(F.col("change_type") != BEFORE_UPDATE)
    kept = kept.withColumn("content", F.when(deleted, "").otherwise(F.coalesce("content", F.lit(""))))
    digested = kept.withColumn("content_digest", content_digest(F.col("content")))
    embedded = embed(digested, "content").withColumn("embedding", F.when(~deleted, F.col("embedding")))
    rows = embedded.withColumn("content", F.when(~deleted, F.col("content")))
    return rows.withColumn("arrived", F.current_timestamp()).select(*LOG_COLUMNS)


def sync_index(
    spark: SparkSession,
    documents: DataFrame,
    log_path: str,
    version: int,
    embed: Embedder = embed_text,
    compacted: int | None = None,
) -> None:
    """Bring the index up to a snapshot of the document table.

    Finds what changed from keys and digests alone. The changed keys are written first, so their size
    is known when their texts are fetched: few are broadcast to the scan of the documents, many are
    shuffled. The result goes to ``log/commit_version=<version>``; a repeated sync replaces itself.
    """
    if version == 0:
        work = documents.withColumn("change_type", F.lit(INSERT))
    else:
        wanted = documents.select(KEY, content_digest(F.coalesce("content", F.lit(""))).alias("content_digest"))
        earlier = spark.read.parquet(log_path).filter(F.col("commit_version") < version)
        kinds = replace_table(
            changed_keys(current_index(earlier, compacted), wanted, KEY, "content_digest"), fresh_dir(spark, "changed-keys")
        )
        changed = documents.join(kinds, KEY)
        removed = kinds.filter(F.col("change_type") == DELETE)
        work = changed.unionByName(removed, allowMissingColumns=True)
    rows = _log_rows(work.withColumn("commit_version", F.lit(version)), embed)
    rows.drop("commit_version").write.mode("overwrite").parquet(f"{log_path}/commit_version={version}")


def publish_changes(before: DataFrame | None, after: DataFrame, feed: str, version: int) -> None:
    """Write the change rows that lead from one snapshot to the next to the table's change feed.

    Publishing a version again replaces it. An index that has taken in the earlier rows takes in the
    new ones as well, and they win, because they arrive later.
    """
    if before is None:
        changes = after.select(F.lit(INSERT).alias("change_type"), "*")
    else:
        changes = snapshot_changes(before, after, KEY)
    changes.write.mode("overwrite").parquet(f"{feed}/commit_version={version}")


def run_index_sync(
    spark: SparkSession, feed: str, log_path: str, checkpoint: str, embed: Embedder = embed_text
) -> None:
    """Triggered sync: add what is new in the change feed to the index log. No state, no shuffle."""
    drain(append_table(_log_rows(stream_table(spark, feed), embed), log_path, checkpoint))


def compact_index(spark: SparkSession, log_path: str, target: str) -> DataFrame:
    """Write the current rows as a new log at ``target``.

    Pass the newest version it holds to :func:`current_index` as ``compacted``.
    """
    current = current_index(spark.read.parquet(log_path)).withColumns({"change_type": F.lit(INSERT), "arrived": F.current_timestamp()})
    current.select(*LOG_COLUMNS).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
