"""Orders and line items joined on derived text keys, with stored and computed filters."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.keys import FILTER_KEY_PREFIX, KEY_WIDTH, ORDER_KEY_PREFIX, derived_key
from millrace.functions.register import register_functions
from millrace.operators.joins import (
    check_key_space,
    join_left_columns,
    replicate,
    semi_join,
    semi_join_pruned,
)
from millrace.operators.statistics import analyze_table
from millrace.operators.tables import files_for, replace_catalog_table, replace_table, write_with_bloom_filters
from millrace.plans.common import built_once, stored_path
from millrace.session import session_with
from millrace.sources.tables import fixture
from millrace.workspace import fresh_dir

# How often the tables are replicated and how far apart the copies' keys are.
COPIES = 10
STRIDE = 100_000_000

KEY = "orderkey_pre"
# The stored copies are ten times their source. Keys in order are stored as differences, which takes version 2 and no dictionary.
_ORDERED = (KEY, "filter_pre", "orderkey_clc", "filter_clc", "l_orderkey", "o_orderkey")
STORED_AS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    **{f"parquet.enable.dictionary#{column}": "false" for column in _ORDERED},
}
POINT = "filter_0000000012"


def _keyed_lines(copies: DataFrame) -> DataFrame:
    return copies.select(derived_key(ORDER_KEY_PREFIX, F.col("l_orderkey") + F.col("id")).alias(KEY), "*")


def _keyed_orders(copies: DataFrame) -> DataFrame:
    number = F.col("o_orderkey") + F.col("id")
    return copies.select(
        derived_key(ORDER_KEY_PREFIX, number).alias(KEY),
        derived_key(FILTER_KEY_PREFIX, number).alias("filter_pre"),
        "*",
    )


def lineitem_orig(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_lines(replicate(fixture(spark, sf_dir, "lineitem"), COPIES, STRIDE))


def orders_orig(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_orders(replicate(fixture(spark, sf_dir, "orders"), COPIES, STRIDE))


def orders_with_computed_keys(orders: DataFrame) -> DataFrame:
    return orders.select(
        derived_key(ORDER_KEY_PREFIX, F.col("o_orderkey")).alias("orderkey_clc"),
        derived_key(FILTER_KEY_PREFIX, F.col("o_orderkey")).alias("filter_clc"),
        "*",
    )


def _stored_copies(spark: SparkSession, source: DataFrame, key: str, path: str, with_keys: Callable[[DataFrame], DataFrame]) -> None:
    """Store all copies of ``source`` with ``with_keys`` applied, laid out by key.

    A copy's keys all lie above those of the copy before. So only the source is shuffled and sorted, and stored; each copy
    is then read from it file by file, in order, and neither shuffled nor sorted again.
    """
    check_key_space(source, key, COPIES, STRIDE, KEY_WIDTH)
    files = -(-files_for(spark, source.count() * COPIES) // COPIES)
    base = fresh_dir(spark, "laid-out")
    replace_table(source, base, cluster_by=(key,), files=files, options=STORED_AS)
    # a file of its own for every file that is read: files read together need not lie next to each other
    apart = session_with(spark, {"spark.sql.files.openCostInBytes": "1GB", "spark.sql.files.maxPartitionBytes": "1GB"})
    rows = apart.read.parquet(base)
    copies = (rows.withColumn("id", F.lit(i * STRIDE).cast("bigint")) for i in range(COPIES))
    replace_table(with_keys(reduce(DataFrame.union, copies)), path, options=STORED_AS)


def stored_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with stored keys, laid out by key."""

    def build(path: str) -> None:
        _stored_copies(spark, fixture(spark, sf_dir, "lineitem"), "l_orderkey", path, _keyed_lines)

    return spark.read.parquet(built_once(spark, sf_dir, "lineitem-orig", build))


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with stored keys, laid out by key."""

    def build(path: str) -> None:
        _stored_copies(spark, fixture(spark, sf_dir, "orders"), "o_orderkey", path, _keyed_orders)

    return spark.read.parquet(built_once(spark, sf_dir, "orders-orig", build))


def stored_orders_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain copy of the orders with keys computed without the copy's offset: a table, not a view."""

    def build(path: str) -> None:
        replace_table(orders_with_computed_keys(stored_orders(spark, sf_dir)), path, options=STORED_AS)

    return spark.read.parquet(built_once(spark, sf_dir, "orders-copy", build))


def lineitem_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view: its key column is computed whenever it is read."""
    lines = stored_lineitem(spark, sf_dir)
    lines.select(derived_key(ORDER_KEY_PREFIX, F.col("l_orderkey")).alias("orderkey_clc"), "*").createOrReplaceTempView("keyed_lines")
    return spark.table("keyed_lines")


# The largest Bloom filter, in bits. Every task of the matching orders' scan makes one of that size.
FILTER_BITS = 1 << 28


def _thinning(spark: SparkSession, settings: dict[str, str] | None = None, keys: int = 0) -> SparkSession:
    """A session whose planner thins the scan of a shuffled join's left side by a Bloom filter of the right side's keys.

    Without statistics the planner takes filtered orders to be as large as all, and shuffles both sides before it
    learns how few match; with the filter only the lines of matching orders are shuffled, and a few that it lets through.
    ``keys``, when known, sets the filter's size, 8 bits a key; the default size is good for a million keys.
    """
    sized = {"expectedNumItems": keys, "maxNumItems": keys, "numBits": min(8 * keys, FILTER_BITS), "maxNumBits": FILTER_BITS}
    return session_with(
        spark,
        {
            "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
            "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1TB",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
            **({f"spark.sql.optimizer.runtime.bloomFilter.{name}": str(value) for name, value in sized.items()} if keys else {}),
            **(settings or {}),
        },
    )


def _point(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("filter_pre") == POINT)


# ---------------------------------------------------------------- queries


def derived_keys_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_orig(spark, sf_dir).select(KEY, "l_orderkey", "l_linenumber", "id")


def derived_keys_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders_with_computed_keys(orders_orig(spark, sf_dir))
    return rows.select("orderkey_clc", "filter_clc", KEY, "filter_pre", "o_orderkey", "id")


def replicate_scaleout(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = replicate(fixture(spark, sf_dir, "orders"), COPIES, STRIDE)
    shifted = copies.withColumn("number", F.col("o_orderkey") + F.col("id"))
    return shifted.groupBy("id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.min("number").alias("first_number"),
        F.max("number").alias("last_number"),
    )


def join_table_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = _thinning(spark)
    return join_left_columns(stored_lineitem(session, sf_dir), _point(stored_orders(session, sf_dir)), KEY)


def join_table_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = _thinning(spark)
    return join_left_columns(stored_lineitem(session, sf_dir), _point(stored_orders_copy(session, sf_dir)), KEY)


def join_view_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = _thinning(spark)
    return join_left_columns(lineitem_view(session, sf_dir), _point(stored_orders_copy(session, sf_dir)), KEY)


def join_computed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = _thinning(spark)
    orders = stored_orders(session, sf_dir)
    matching = orders.filter(derived_key(FILTER_KEY_PREFIX, F.col("o_orderkey")) == POINT)
    return join_left_columns(stored_lineitem(session, sf_dir), matching, KEY)


def join_planned_at_runtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join left to the planner alone."""
    session = _thinning(spark)
    return join_left_columns(stored_lineitem(session, sf_dir), _point(stored_orders(session, sf_dir)), KEY)


def semi_join_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = _thinning(spark)
    return semi_join(stored_lineitem(session, sf_dir), _point(stored_orders(session, sf_dir)), KEY)


def semi_join_key_pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = _thinning(spark)
    return semi_join_pruned(stored_lineitem(session, sf_dir), _point(stored_orders(session, sf_dir)), KEY)


def _point_join_text(spark: SparkSession, sf_dir: str) -> str:
    """The join as SQL text over views of the stored tables."""
    stored_lineitem(spark, sf_dir).createOrReplaceTempView("lines")
    stored_orders(spark, sf_dir).createOrReplaceTempView("ordered")
    columns = ", ".join(f"lines.{c}" for c in spark.table("lines").columns)
    return f"SELECT {columns} FROM ordered JOIN lines ON lines.{KEY} = ordered.{KEY} WHERE ordered.filter_pre = '{POINT}'"


def join_sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = _thinning(spark)
    return session.sql(_point_join_text(session, sf_dir))


def join_output_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result stored as a table in place of other rows: first all line items of large orders are there, under more columns."""
    name, path = f"point_join_result_{uuid.uuid4().hex[:12]}", fresh_dir(spark, "join-result")
    earlier = stored_lineitem(spark, sf_dir).filter("l_quantity > 45").withColumn("note", F.lit("earlier"))
    replace_catalog_table(earlier, name, path)
    replaced = spark.table(name).agg(F.count(F.lit(1)).alias("rows_before"))
    before = replaced.first()["rows_before"]
    session = _thinning(spark)
    replace_catalog_table(session.sql(_point_join_text(session, sf_dir)), name, path)
    spark.catalog.refreshTable(name)
    return spark.table(name).withColumn("rows_before", F.lit(before).cast("bigint"))


def bloom_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point lookup by part, by which the line items are not laid out: row groups without the part are skipped by their filters."""
    lines = fixture(spark, sf_dir, "lineitem").repartition(16, F.xxhash64("l_orderkey", "l_linenumber"))
    stored = write_with_bloom_filters(lines, fresh_dir(spark, "bloom"), {"l_partkey": 50_000})
    return stored.filter(F.col("l_partkey") == 7).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def _analyzed(spark: SparkSession, sf_dir: str, label: str, name: str, table: DataFrame, columns: list[str]) -> str:
    """A named table over stored files, with statistics for the columns a join asks about; made once."""

    def build(_: str) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, stored_path(spark, sf_dir, label), "parquet", table.schema)
        analyze_table(spark, name, columns)

    built_once(spark, sf_dir, f"{label}-analyzed", build)
    return name


def join_with_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with column statistics: the planner knows before it starts how few orders match."""
    session = session_with(spark, {"spark.sql.cbo.enabled": "true"})
    lines, orders = stored_lineitem(spark, sf_dir), stored_orders(spark, sf_dir)
    # a name per folder: the statistics belong to its files
    suffix = hashlib.md5(sf_dir.rstrip("/").encode(), usedforsecurity=False).hexdigest()[:12]
    line_table = _analyzed(spark, sf_dir, "lineitem-orig", f"lines_analyzed_{suffix}", lines, [KEY])
    order_table = _analyzed(spark, sf_dir, "orders-orig", f"orders_analyzed_{suffix}", orders, [KEY, "filter_pre"])
    return join_left_columns(session.table(line_table), _point(session.table(order_table)), KEY)


def join_broadcast_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planner broadcasts the matching orders when their bytes, measured while running, are below its threshold."""
    session = _thinning(
        spark, {"spark.sql.autoBroadcastJoinThreshold": "16MB", "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB"}
    )
    return join_left_columns(stored_lineitem(session, sf_dir), _point(stored_orders(session, sf_dir)), KEY)


def _urgent(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderpriority") == "1-URGENT")


def _revenue(lines: DataFrame) -> DataFrame:
    return lines.groupBy("id", "l_returnflag").agg(
        F.count(F.lit(1)).alias("line_items"), F.round(F.sum("l_extendedprice"), 2).alias("revenue")
    )


def join_shuffle_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the orders match: too many to broadcast at scale."""
    session = session_with(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"})
    lines, orders = stored_lineitem(session, sf_dir), _urgent(stored_orders(session, sf_dir))
    return _revenue(join_left_columns(lines, orders, KEY, strategy="shuffle_hash"))


def _urgent_thinning(spark: SparkSession, sf_dir: str) -> SparkSession:
    keys = _urgent(stored_orders(spark, sf_dir)).count()
    return _thinning(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}, keys)


def join_sort_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = _urgent_thinning(spark, sf_dir)
    lines, orders = stored_lineitem(session, sf_dir), _urgent(stored_orders(session, sf_dir))
    return _revenue(join_left_columns(lines, orders, KEY, strategy="merge"))


def join_bloom_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffled join whose line-item scan is thinned by a Bloom filter of the matching orders' keys."""
    session = _urgent_thinning(spark, sf_dir)
    lines, orders = stored_lineitem(session, sf_dir), _urgent(stored_orders(session, sf_dir))
    return _revenue(join_left_columns(lines, orders, KEY, strategy="shuffle_hash"))


def sql_udf_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    fixture(spark, sf_dir, "orders").createOrReplaceTempView("orders_for_keys")
    return spark.sql("SELECT o_orderkey, sample_udf('orderkey_', o_orderkey) AS order_key FROM orders_for_keys")


def clustered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_lineitem(spark, sf_dir).filter(F.col(KEY) == f"{ORDER_KEY_PREFIX}0500000012")


def clustered_by_heavy_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster by a column with three values, each a third of the rows, and read one of them back."""

    def build(path: str) -> None:
        source = fixture(spark, sf_dir, "lineitem")
        replace_table(source, path, cluster_by=("l_returnflag",), files=files_for(spark, source.count()))

    rows = spark.read.parquet(built_once(spark, sf_dir, "lineitem-by-flag", build))
    returned = rows.filter(F.col("l_returnflag") == "R")
    return returned.groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("line_items"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


QUERIES = {
    "derived_keys_lineitem": derived_keys_lineitem,
    "derived_keys_orders": derived_keys_orders,
    "replicate_scaleout": replicate_scaleout,
    "join_table_table": join_table_table,
    "join_table_copy": join_table_copy,
    "join_view_copy": join_view_copy,
    "join_computed_filter": join_computed_filter,
    "join_planned_at_runtime": join_planned_at_runtime,
    "join_sql_text": join_sql_text,
    "join_output_table": join_output_table,
    "bloom_lookup": bloom_lookup,
    "join_with_statistics": join_with_statistics,
    "semi_join_in": semi_join_in,
    "semi_join_key_pushdown": semi_join_key_pushdown,
    "join_broadcast_checked": join_broadcast_checked,
    "join_shuffle_hash": join_shuffle_hash,
    "join_sort_merge": join_sort_merge,
    "join_bloom_filter": join_bloom_filter,
    "sql_udf_keys": sql_udf_keys,
    "clustered_lookup": clustered_lookup,
    "clustered_by_heavy_key": clustered_by_heavy_key,
}

_TABLES = f"""
    WITH copies AS (SELECT range * {STRIDE} AS id FROM range({COPIES})),
    lineitem_orig AS (
        SELECT 'orderkey_' || lpad(CAST(l_orderkey + id AS VARCHAR), 10, '0') AS orderkey_pre, l.*, id
        FROM lineitem l CROSS JOIN copies
    ),
    orders_orig AS (
        SELECT 'orderkey_' || lpad(CAST(o_orderkey + id AS VARCHAR), 10, '0') AS orderkey_pre,
               'filter_' || lpad(CAST(o_orderkey + id AS VARCHAR), 10, '0') AS filter_pre, o.*, id
        FROM orders o CROSS JOIN copies
    )
"""
_POINT_JOIN = f"""{_TABLES}
    SELECT A.* FROM lineitem_orig A JOIN orders_orig B USING (orderkey_pre) WHERE B.filter_pre = '{POINT}'
"""
_URGENT_REVENUE = f"""{_TABLES}
    SELECT A.id, A.l_returnflag, count(*) AS line_items, round(sum(A.l_extendedprice), 2) AS revenue
    FROM lineitem_orig A JOIN orders_orig B USING (orderkey_pre)
    WHERE B.o_orderpriority = '1-URGENT' GROUP BY A.id, A.l_returnflag
"""

ORACLES = {
    "derived_keys_lineitem": f"{_TABLES} SELECT orderkey_pre, l_orderkey, l_linenumber, id FROM lineitem_orig",
    "derived_keys_orders": f"""{_TABLES}
        SELECT 'orderkey_' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS orderkey_clc,
               'filter_' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS filter_clc,
               orderkey_pre, filter_pre, o_orderkey, id
        FROM orders_orig
    """,
    "replicate_scaleout": f"""
        SELECT id, count(*) AS orders, min(o_orderkey + id) AS first_number, max(o_orderkey + id) AS last_number
        FROM orders CROSS JOIN (SELECT range * {STRIDE} AS id FROM range({COPIES})) GROUP BY id
    """,
    "join_table_table": _POINT_JOIN,
    "join_table_copy": _POINT_JOIN,
    "join_view_copy": f"""{_TABLES}
        SELECT 'orderkey_' || lpad(CAST(A.l_orderkey AS VARCHAR), 10, '0') AS orderkey_clc, A.*
        FROM lineitem_orig A JOIN orders_orig B USING (orderkey_pre) WHERE B.filter_pre = '{POINT}'
    """,
    "join_computed_filter": f"""{_TABLES}
        SELECT A.* FROM lineitem_orig A JOIN orders_orig B USING (orderkey_pre)
        WHERE 'filter_' || lpad(CAST(B.o_orderkey AS VARCHAR), 10, '0') = '{POINT}'
    """,
    "join_planned_at_runtime": _POINT_JOIN,
    "join_sql_text": _POINT_JOIN,
    "bloom_lookup": "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_partkey = 7",
    "join_output_table": f"""
        SELECT *, (SELECT CAST({COPIES} * count(*) AS BIGINT) FROM lineitem WHERE l_quantity > 45) AS rows_before FROM ({_POINT_JOIN})
    """,
    "join_with_statistics": _POINT_JOIN,
    "semi_join_in": f"""{_TABLES}
        SELECT * FROM lineitem_orig
        WHERE orderkey_pre IN (SELECT orderkey_pre FROM orders_orig WHERE filter_pre = '{POINT}')
    """,
    "semi_join_key_pushdown": _POINT_JOIN,
    "join_broadcast_checked": _POINT_JOIN,
    "join_shuffle_hash": _URGENT_REVENUE,
    "join_sort_merge": _URGENT_REVENUE,
    "join_bloom_filter": _URGENT_REVENUE,
    "sql_udf_keys": """
        SELECT o_orderkey, 'orderkey_' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS order_key FROM orders
    """,
    "clustered_lookup": f"{_TABLES} SELECT * FROM lineitem_orig WHERE orderkey_pre = 'orderkey_0500000012'",
    "clustered_by_heavy_key": """
        SELECT l_linestatus, count(*) AS line_items, round(sum(l_quantity), 2) AS quantity
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_linestatus
    """,
}
