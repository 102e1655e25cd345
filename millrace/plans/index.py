"""Snapshots, their change rows, and an index kept in step with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.changes import snapshot_changes, store_snapshot, stored_snapshot_changes
from millrace.sources.tables import fixture
from millrace.streaming.index_sync import compact_index, current_index, publish_changes, run_index_sync, sync_index
from millrace.streaming.keyed_sync import compact_keyed_index, keyed_index, run_keyed_sync
from millrace.workspace import fresh_dir


def snapshot_change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-priority orders are new, open ones are gone, urgent ones cost more."""
    orders = fixture(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    before = orders.filter(F.col("o_orderpriority") != "5-LOW")
    raised = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 100)
    after = orders.filter(F.col("o_orderstatus") != "O").withColumn(
        "o_totalprice", F.coalesce(raised, F.col("o_totalprice"))
    )
    # a column that the earlier snapshot does not have
    after = after.withColumn("rush", F.when(F.col("o_orderpriority") == "2-HIGH", "yes"))
    return snapshot_changes(before, after, "o_orderkey")


def stored_snapshot_change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes between stored snapshots: a few orders cost more or are gone, so only the buckets of their keys are read."""
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    orders = fixture(spark, sf_dir, "orders").select(*columns)
    touched = F.col("o_orderkey") % 1000 == 1
    raised = orders.withColumn("o_totalprice", F.when(touched, F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice")))
    before, after = fresh_dir(spark, "snapshot-before"), fresh_dir(spark, "snapshot-after")
    store_snapshot(orders, before, "o_orderkey", buckets=32)
    store_snapshot(raised.filter(F.col("o_orderkey") % 1000 != 3), after, "o_orderkey", buckets=32)
    return stored_snapshot_changes(spark, before, after, "o_orderkey")


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """English documents get a longer text, Spanish ones are new, German ones are gone."""
    documents = fixture(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("document_id"),
        F.concat(F.lit("https://example.com/"), F.col("source")).alias("original_url"),
        F.col("text").alias("content"),
        "lang",
    )
    first = documents.filter(F.col("lang") != "es").drop("lang")
    longer = F.when(F.col("lang") == "en", F.concat(F.col("content"), F.lit("\nRevised."))).otherwise(F.col("content"))
    second = documents.filter(F.col("lang") != "de").withColumn("content", longer).drop("lang")
    return first, second


def _index_rows(index: DataFrame) -> DataFrame:
    return index.select(
        "document_id",
        F.col("commit_version").cast("bigint").alias("commit_version"),
        "original_url",
        F.length("content").cast("bigint").alias("content_length"),
        "content_digest",
        F.size("embedding").cast("bigint").alias("dimensions"),
    )


def index_sync_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fresh_dir(spark, "index-log")
    for version, snapshot in enumerate(_snapshots(spark, sf_dir)):
        sync_index(spark, snapshot, log, version)
    return _index_rows(current_index(spark.read.parquet(log)))


def index_sync_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, log, checkpoint = (fresh_dir(spark, label) for label in ("feed", "index-log", "index-checkpoint"))
    first, second = _snapshots(spark, sf_dir)
    publish_changes(None, first, feed, 0)
    run_index_sync(spark, feed, log, checkpoint)
    # the version comes out with wrong texts at first, is taken in, and comes out again
    publish_changes(first, second.withColumn(
        "content", F.when(F.col("original_url").isNotNull() & F.col("content").endswith("Revised."), F.lit("wrong")).otherwise(F.col("content"))
    ), feed, 1)
    run_index_sync(spark, feed, log, checkpoint)
    publish_changes(first, second, feed, 1)
    run_index_sync(spark, feed, log, checkpoint)
    return _index_rows(compact_index(spark, log, fresh_dir(spark, "index-compacted")))


def index_sync_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State per document: a version that is published again after the log was compacted past it is seen by the compacted read."""
    feed, log, checkpoint, base = (fresh_dir(spark, label) for label in ("feed", "keyed-log", "keyed-checkpoint", "keyed-base"))
    first, second = _snapshots(spark, sf_dir)
    wrong = second.withColumn("content", F.when(F.col("content").endswith("Revised."), F.lit("wrong")).otherwise(F.col("content")))
    publish_changes(None, first, feed, 0)
    publish_changes(first, wrong, feed, 1)
    run_keyed_sync(spark, feed, log, checkpoint)
    compact_keyed_index(spark, log, base)
    publish_changes(first, second, feed, 1)
    run_keyed_sync(spark, feed, log, checkpoint)
    return _index_rows(keyed_index(spark, log, base))


QUERIES = {
    "snapshot_change_rows": snapshot_change_rows,
    "stored_snapshot_change_rows": stored_snapshot_change_rows,
    "index_sync_upsert": index_sync_upsert,
    "index_sync_stream": index_sync_stream,
    "index_sync_keyed": index_sync_keyed,
}

_INDEX = """
    SELECT CAST(doc_id AS VARCHAR) AS document_id,
           CAST(CASE WHEN lang IN ('en', 'es') THEN 1 ELSE 0 END AS BIGINT) AS commit_version,
           'https://example.com/' || source AS original_url,
           CAST(length(CASE WHEN lang = 'en' THEN text || chr(10) || 'Revised.' ELSE text END) AS BIGINT) AS content_length,
           sha256(CASE WHEN lang = 'en' THEN text || chr(10) || 'Revised.' ELSE text END) AS content_digest,
           CAST(256 AS BIGINT) AS dimensions
    FROM documents WHERE lang <> 'de'
"""

ORACLES = {
    "stored_snapshot_change_rows": """
        SELECT 'delete' AS change_type, o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 1000 = 3
        UNION ALL SELECT 'update_preimage', o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 1000 = 1
        UNION ALL SELECT 'update_postimage', o_orderkey, o_custkey, o_totalprice + 100 FROM orders WHERE o_orderkey % 1000 = 1
    """,
    "snapshot_change_rows": """
        WITH o AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders),
        b AS (SELECT *, CAST(NULL AS VARCHAR) AS rush FROM o WHERE o_orderpriority <> '5-LOW'),
        a AS (SELECT o_orderkey, o_orderstatus,
                     CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
                     o_orderpriority, CASE WHEN o_orderpriority = '2-HIGH' THEN 'yes' END AS rush
              FROM o WHERE o_orderstatus <> 'O')
        SELECT 'insert' AS change_type, a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = a.o_orderkey)
        UNION ALL
        SELECT 'delete', b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.o_orderkey = b.o_orderkey)
        UNION ALL
        SELECT 'update_preimage', b.* FROM b JOIN a USING (o_orderkey)
        WHERE (a.o_orderstatus, a.o_totalprice, a.o_orderpriority, a.rush)
              IS DISTINCT FROM (b.o_orderstatus, b.o_totalprice, b.o_orderpriority, b.rush)
        UNION ALL
        SELECT 'update_postimage', a.* FROM b JOIN a USING (o_orderkey)
        WHERE (a.o_orderstatus, a.o_totalprice, a.o_orderpriority, a.rush)
              IS DISTINCT FROM (b.o_orderstatus, b.o_totalprice, b.o_orderpriority, b.rush)
    """,
    "index_sync_upsert": _INDEX,
    "index_sync_stream": _INDEX,
    "index_sync_keyed": _INDEX,
}
