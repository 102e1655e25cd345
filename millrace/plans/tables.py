"""Scans, previews, parameters and statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.preview import preview
from millrace.operators.statistics import (
    analyze_table,
    append_statistics,
    column_profile,
    distinct_counts,
    merged_statistics,
    stored_statistics,
)
from millrace.operators.tables import replace_catalog_table, set_parameter
from millrace.sources.tables import catalog_table, fixture, number_range, path_table, rows_in_memory, use_catalog
from millrace.workspace import fresh_dir


def preview_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(fixture(spark, sf_dir, "orders"), "o_orderkey")


def _saved_orders(spark: SparkSession, sf_dir: str) -> str:
    name = f"saved_orders_{uuid.uuid4().hex[:12]}"
    replace_catalog_table(fixture(spark, sf_dir, "orders"), name, fresh_dir(spark, "saved-orders"))
    return name


def catalog_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _saved_orders(spark, sf_dir)
    use_catalog(spark, "spark_catalog")
    orders = catalog_table(spark, f"spark_catalog.{spark.catalog.currentDatabase()}.{name}")
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


def path_addressed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = path_table(spark, f"{sf_dir}/customer.parquet")
    return nations.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))


def parameter_in_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = spark.newSession()
    set_parameter(session, "DATA_BUCKET_NAME", sf_dir)
    return session.sql("""
        SELECT p_brand, count(*) AS parts FROM parquet.`${DATA_BUCKET_NAME}/part.parquet` GROUP BY p_brand
    """)


def rows_in_memory_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handful of literal rows, broadcast as such, next to all line items."""
    meanings = [("A", "accepted"), ("N", "none"), ("R", "returned")]
    flags = rows_in_memory(spark, meanings, "l_returnflag string, meaning string")
    lines = fixture(spark, sf_dir, "lineitem").join(F.broadcast(flags), "l_returnflag")
    return lines.groupBy("meaning").agg(F.count(F.lit(1)).alias("line_items"))


def number_range_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of every month number, months without orders included."""
    months = number_range(spark, 12).select((F.col("id") + 1).alias("month_number"))
    orders = fixture(spark, sf_dir, "orders").select(F.month("o_orderdate").cast("bigint").alias("month_number"))
    counted = orders.groupBy("month_number").agg(F.count(F.lit(1)).alias("orders"))
    joined = months.join(counted, "month_number", "left")
    return joined.select("month_number", F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders"))


def profile_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_profile(fixture(spark, sf_dir, "orders"), exact=True)


def _close(estimate: Column, exact: Column, tolerance: float) -> Column:
    return F.abs(estimate - exact) <= F.ceil(tolerance * exact)


def _with_judged_counts(spark: SparkSession, sf_dir: str, profile: DataFrame, tolerance: float) -> DataFrame:
    """``distinct_values`` is an estimate: it is exchanged for whether it is near the exact number."""
    exact = distinct_counts(fixture(spark, sf_dir, "orders")).withColumnRenamed("distinct_values", "exact")
    judged = _close(F.col("distinct_values").cast("double"), F.coalesce("exact", F.lit(0)), tolerance)
    return profile.join(exact, "column_name", "left").withColumn("distinct_close", judged).drop("distinct_values", "exact")


def profile_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-pass profile; its distinct counts are within 8 % (four standard deviations) of the exact ones."""
    return _with_judged_counts(spark, sf_dir, column_profile(fixture(spark, sf_dir, "orders")), 0.08)


def statistics_of_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All measures after three appends, merged from stored sketches; estimates are judged against exact values."""
    orders, path = fixture(spark, sf_dir, "orders"), fresh_dir(spark, "sketches")
    for part in range(3):
        append_statistics(orders.filter(F.col("o_orderkey") % 3 == part), path)
    merged = merged_statistics(spark, path, (0.25, 0.75))
    # the rank of an estimated quantile is near the rank asked for
    sizes = orders.select(*[F.col(c).cast("double").alias(c) for c in _NUMERIC])
    wanted = merged.filter("quantiles is not null").select("column_name", F.posexplode("quantiles").alias("at", "value"))
    pairs = sizes.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("x")) for c in _NUMERIC])))
    ranks = pairs.join(F.broadcast(wanted), "column_name").groupBy("column_name", "at").agg(
        F.avg((F.col("x") <= F.col("value")).cast("double")).alias("rank")
    )
    near = ranks.groupBy("column_name").agg(
        F.max(F.abs(F.col("rank") - F.when(F.col("at") == 0, 0.25).otherwise(0.75))).alias("off")
    )
    judged = _with_judged_counts(spark, sf_dir, merged.drop("quantiles"), 0.04).join(near, "column_name", "left")
    return judged.withColumn("quantiles_close", F.coalesce(F.col("off") <= 0.02, F.lit(True))).drop("off")


def table_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the catalog stores; its distinct counts are estimates with 5 % standard deviation by default."""
    name = _saved_orders(spark, sf_dir)
    analyze_table(spark, name)
    stored = stored_statistics(spark, name).select(
        "column_name",
        F.col("nulls").cast("bigint").alias("nulls"),
        F.expr("try_cast(min_value AS double)").alias("min_number"),
        F.expr("try_cast(max_value AS double)").alias("max_number"),
        F.col("avg_len").cast("bigint").alias("avg_len"),
        F.col("max_len").cast("bigint").alias("max_len"),
        F.col("distinct_values").cast("bigint").alias("distinct_values"),
    )
    return _with_judged_counts(spark, sf_dir, stored, 0.2)


QUERIES = {
    "preview_orders": preview_orders,
    "catalog_table_scan": catalog_table_scan,
    "path_addressed_scan": path_addressed_scan,
    "parameter_in_path": parameter_in_path,
    "rows_in_memory_join": rows_in_memory_join,
    "number_range_months": number_range_months,
    "profile_exact": profile_exact,
    "profile_one_pass": profile_one_pass,
    "statistics_of_batches": statistics_of_batches,
    "table_statistics": table_statistics,
}


_NUMERIC = {"o_orderkey": 8, "o_custkey": 8, "o_totalprice": 8}
_TEXT = ("o_orderstatus", "o_orderpriority")


def _profile_sql(distinct: bool, more: str = "") -> str:
    def line(column: str, numbers: str, texts: str, lengths: str) -> str:
        counted = f"count(DISTINCT {column}) AS distinct_values," if distinct else f"true AS distinct_close, {more}"
        return f"""SELECT '{column}' AS column_name, count(*) AS rows, count(*) - count({column}) AS nulls, {counted}
            {numbers}, {texts}, {lengths} FROM orders"""

    no_numbers = "CAST(NULL AS DOUBLE) AS min_number, CAST(NULL AS DOUBLE) AS max_number"
    no_texts = "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text"
    fixed = "CAST(8 AS BIGINT) AS avg_len, CAST(8 AS BIGINT) AS max_len"
    parts = [
        line(c, f"CAST(min({c}) AS DOUBLE) AS min_number, CAST(max({c}) AS DOUBLE) AS max_number", no_texts, fixed)
        for c in _NUMERIC
    ]
    parts += [
        line(
            c,
            no_numbers,
            f"min({c}) AS min_text, max({c}) AS max_text",
            f"CAST(ceil(avg(length({c}))) AS BIGINT) AS avg_len, "
            f"CAST(max(length({c})) AS BIGINT) AS max_len",
        )
        for c in _TEXT
    ]
    dates = "strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS min_text, " \
        "strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS max_text"
    parts.append(line("o_orderdate", no_numbers, dates, fixed))
    return " UNION ALL ".join(parts)


_STATISTICS = " UNION ALL ".join(
    [
        f"""SELECT '{c}' AS column_name, CAST(0 AS BIGINT) AS nulls, CAST(min({c}) AS DOUBLE) AS min_number,
            CAST(max({c}) AS DOUBLE) AS max_number, CAST(8 AS BIGINT) AS avg_len, CAST(8 AS BIGINT) AS max_len,
            true AS distinct_close FROM orders"""
        for c in _NUMERIC
    ]
    + [
        f"""SELECT '{c}', CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
            CAST(ceil(avg(length({c}))) AS BIGINT), CAST(max(length({c})) AS BIGINT), true FROM orders"""
        for c in _TEXT
    ]
    + ["SELECT 'o_orderdate', CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(8 AS BIGINT), CAST(8 AS BIGINT), true"]
)

ORACLES = {
    "preview_orders": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10",
    "catalog_table_scan": "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus",
    "path_addressed_scan": "SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey",
    "parameter_in_path": "SELECT p_brand, count(*) AS parts FROM part GROUP BY p_brand",
    "rows_in_memory_join": """
        SELECT meaning, count(*) AS line_items FROM lineitem
        JOIN (VALUES ('A', 'accepted'), ('N', 'none'), ('R', 'returned')) f(l_returnflag, meaning)
        USING (l_returnflag) GROUP BY meaning
    """,
    "number_range_months": """
        SELECT range + 1 AS month_number, count(o_orderkey) AS orders
        FROM range(12) LEFT JOIN orders ON month(o_orderdate) = range + 1 GROUP BY range
    """,
    "profile_exact": _profile_sql(distinct=True),
    "profile_one_pass": _profile_sql(distinct=False),
    "statistics_of_batches": _profile_sql(distinct=False, more="true AS quantiles_close,"),
    "table_statistics": _STATISTICS,
}
