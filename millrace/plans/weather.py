"""Observations per day and area: CSV files to bronze, silver and gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.aggregates import monthly_average
from millrace.operators.quality import Constraint, count_violations, drop_violations
from millrace.operators.tables import refresh_view
from millrace.plans.common import built_once
from millrace.sources.csv import BAD_RECORD, csv_view, read_csv_directory
from millrace.sources.tables import fixture
from millrace.streaming.csv_ingest import ingest_csv, read_ingested
from millrace.streaming.medallion import (
    current_gold,
    gold_from_totals,
    run_bronze,
    run_gold,
    run_silver,
    run_totals_log,
    run_violation_log,
    total_violations,
)
from millrace.workspace import fresh_dir

# Column and constraint names of the observation tables.
DAY = "ymd"
AREA_1 = "area_1"
AREA_2 = "area_2"
TEMPERATURE = "平均気温（℃）計測値"
CONSTRAINTS = (
    Constraint("cons_ymd_is_notnull", "ymd IS NOT NULL"),
    Constraint("cons_area1_is_notnull", "area_1 IS NOT NULL"),
    Constraint("cons_area2_is_notnull", "area_2 IS NOT NULL"),
)

DECIMALS = 6


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as observations. Some days and areas are made null, as the table has no nulls."""
    return fixture(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("value") >= 1, F.col("ts").cast("date")).alias(DAY),
        F.nullif("user_id", F.lit(1)).alias(AREA_1),
        F.nullif("event_type", F.lit("error")).alias(AREA_2),
        F.col("value").alias(TEMPERATURE),
    )


_OBSERVATIONS_SQL = """
    SELECT event_id,
           CASE WHEN value >= 1 THEN strftime(ts, '%Y-%m-%d') END AS ymd,
           CASE WHEN value >= 1 THEN strftime(ts, '%Y-%m') END AS ym,
           nullif(user_id, 1) AS area_1,
           nullif(event_type, 'error') AS area_2,
           value AS temp
    FROM events
"""


def _for_output(rows: DataFrame, *more: str) -> DataFrame:
    # types inferred from CSV may be narrower than the table's
    number, area = (F.col(c).cast("bigint").alias(c) for c in ("event_id", AREA_1))
    day = F.col(DAY).cast("string").alias(DAY)
    return rows.select(number, day, area, AREA_2, F.col(f"`{TEMPERATURE}`").alias("temp"), *more)


def _rounded(gold: DataFrame) -> DataFrame:
    return gold.withColumn("temp", F.round("temp", DECIMALS))


def observation_csv(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        observations(spark, sf_dir).write.option("header", True).csv(path)

    return built_once(spark, sf_dir, "observation-csv", build)


# ---------------------------------------------------------------- batch


def gold_monthly_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = drop_violations(observations(spark, sf_dir), CONSTRAINTS)
    return _rounded(monthly_average(silver, DAY, AREA_2, TEMPERATURE))


def raw_monthly_avg_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices are money: averaged as decimals, the result is exact to six places."""
    orders = fixture(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    averages = monthly_average(orders, "o_orderdate", "o_orderpriority", price, "area_2", "temp")
    return averages.orderBy("ym", "temp").withColumn("temp", F.col("temp").cast("double"))


def silver_drop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _for_output(drop_violations(observations(spark, sf_dir), CONSTRAINTS))


def silver_violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_violations(observations(spark, sf_dir), CONSTRAINTS)


def csv_batch_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _for_output(read_csv_directory(spark, observation_csv(spark, sf_dir)))


def csv_view_monthly_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv_view(spark, "observation_files", observation_csv(spark, sf_dir))
    averages = monthly_average(spark.table("observation_files"), DAY, AREA_2, TEMPERATURE, "area_2", "temp")
    return _rounded(averages.orderBy("ym", "temp"))


# ---------------------------------------------------------------- streams


def _bronze(spark: SparkSession, sf_dir: str) -> str:
    folder = observation_csv(spark, sf_dir)
    bronze = fresh_dir(spark, "bronze")
    schema = read_csv_directory(spark, folder).schema
    run_bronze(spark, folder, schema, bronze, fresh_dir(spark, "bronze-checkpoint"))
    return bronze


def _silver(spark: SparkSession, sf_dir: str) -> str:
    silver = fresh_dir(spark, "silver")
    run_silver(spark, _bronze(spark, sf_dir), silver, fresh_dir(spark, "silver-checkpoint"), CONSTRAINTS)
    return silver


def csv_stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _for_output(spark.read.parquet(_bronze(spark, sf_dir)))


def stream_silver_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _for_output(spark.read.parquet(_silver(spark, sf_dir)))


def stream_violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fresh_dir(spark, "violations")
    run_violation_log(spark, _bronze(spark, sf_dir), log, fresh_dir(spark, "violations-checkpoint"), CONSTRAINTS)
    return total_violations(spark, log)


def gold_after_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = spark.read.parquet(_silver(spark, sf_dir))
    gold = monthly_average(silver, DAY, AREA_2, TEMPERATURE)
    return _rounded(refresh_view(gold, "observation_gold", fresh_dir(spark, "gold")))


def gold_from_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, checkpoint = fresh_dir(spark, "totals"), fresh_dir(spark, "totals-checkpoint")
    run_totals_log(spark, _silver(spark, sf_dir), log, checkpoint, DAY, AREA_2, TEMPERATURE)
    return _rounded(gold_from_totals(spark, log))


def _bronze_in_rounds(spark: SparkSession, sf_dir: str):
    """The folder of a bronze table that grows: yields after each of two rounds."""
    rows, bronze = observations(spark, sf_dir), fresh_dir(spark, "growing-bronze")
    for odd in (0, 1):
        rows.filter(F.col("event_id") % 2 == odd).write.mode("append").parquet(bronze)
        yield bronze


def silver_counts_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations that two rounds of the silver stream counted on their way, next to the rows they let through."""
    silver, checkpoint = fresh_dir(spark, "silver"), fresh_dir(spark, "silver-checkpoint")
    total = dict.fromkeys((c.name for c in CONSTRAINTS), 0)
    for bronze in _bronze_in_rounds(spark, sf_dir):
        for name, n in run_silver(spark, bronze, silver, checkpoint, CONSTRAINTS).items():
            total[name] += n
    counted = spark.createDataFrame(list(total.items()), "constraint_name string, violations bigint")
    kept = spark.read.parquet(silver).agg(F.count(F.lit(1)).alias("violations"))
    return counted.unionByName(kept.select(F.lit("rows kept").alias("constraint_name"), "violations"))


def gold_stateful_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of a stream whose state holds the monthly totals."""
    gold, checkpoint = fresh_dir(spark, "gold-state"), fresh_dir(spark, "gold-state-checkpoint")
    silver = fresh_dir(spark, "silver")
    for bronze in _bronze_in_rounds(spark, sf_dir):
        run_silver(spark, bronze, silver, f"{checkpoint}/silver", CONSTRAINTS)
        run_gold(spark, silver, gold, f"{checkpoint}/gold", DAY, AREA_2, TEMPERATURE)
    return _rounded(current_gold(spark, gold))


def csv_merge_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases come in files with another column order and one more column, in a second round."""
    rows = observations(spark, sf_dir)
    props = fixture(spark, sf_dir, "events").select("event_id", "props")
    purchase = F.col(AREA_2) == "purchase"
    folder, table = fresh_dir(spark, "mixed-csv"), fresh_dir(spark, "merged-bronze")
    checkpoint = fresh_dir(spark, "merged-checkpoint")

    plain = rows.filter(~F.coalesce(purchase, F.lit(False)))
    plain.write.option("header", True).csv(f"{folder}/round=1")
    ingest_csv(spark, folder, table, checkpoint)

    wider = rows.filter(purchase).join(props, "event_id").select(AREA_2, AREA_1, TEMPERATURE, DAY, "event_id", "props")
    # JSON text holds quotes, and every third one a line break
    broken = F.concat_ws("\n", "props", "props")
    wider = wider.withColumn("props", F.when(F.col("event_id") % 3 == 0, broken).otherwise(F.col("props")))
    wider.write.option("header", True).csv(f"{folder}/round=2")
    # an odd file: a blank line first, a number of 20 digits, and a cell that does not fit
    odd = [("",), ("event_id,ymd,area_1,area_2," + TEMPERATURE,), (f"{10**19},2024-01-01,1,view,1.5",), ("-1,2024-01-01,2,view,n/a",)]
    spark.createDataFrame(odd, "value string").coalesce(1).write.text(f"{folder}/round=3", lineSep="\n")
    ingest_csv(spark, folder, table, checkpoint, glob="*.{csv,txt}")
    number, day = (F.col(c).cast("string").alias(c) for c in ("event_id", DAY))
    area = F.col(AREA_1).cast("bigint").alias(AREA_1)
    temperature = F.col(f"`{TEMPERATURE}`").alias("temp")
    return read_ingested(spark, table).select(number, day, area, AREA_2, temperature, "props", BAD_RECORD)


QUERIES = {
    "gold_monthly_avg": gold_monthly_avg,
    "raw_monthly_avg_sorted": raw_monthly_avg_sorted,
    "silver_drop_rows": silver_drop_rows,
    "silver_violation_counts": silver_violation_counts,
    "csv_batch_infer": csv_batch_infer,
    "csv_view_monthly_avg": csv_view_monthly_avg,
    "csv_stream_bronze": csv_stream_bronze,
    "csv_merge_headers": csv_merge_headers,
    "stream_silver_from_bronze": stream_silver_from_bronze,
    "stream_violation_counts": stream_violation_counts,
    "gold_after_streams": gold_after_streams,
    "gold_from_new_rows": gold_from_new_rows,
    "silver_counts_observed": silver_counts_observed,
    "gold_stateful_stream": gold_stateful_stream,
}

_ALL_ROWS = f"SELECT event_id, ymd, area_1, area_2, temp FROM ({_OBSERVATIONS_SQL})"
_KEPT = "ymd IS NOT NULL AND area_1 IS NOT NULL AND area_2 IS NOT NULL"
_SILVER_ROWS = f"{_ALL_ROWS} WHERE {_KEPT}"
_GOLD = f"""
    SELECT ym, area_2 AS area, round(avg(temp), {DECIMALS}) AS temp
    FROM ({_OBSERVATIONS_SQL}) WHERE {_KEPT} GROUP BY ym, area_2
"""
_VIOLATIONS = " UNION ALL ".join(
    f"SELECT '{c.name}' AS constraint_name, count(*) FILTER (NOT ({c.predicate})) AS violations "
    f"FROM ({_OBSERVATIONS_SQL})"
    for c in CONSTRAINTS
)

ORACLES = {
    "gold_monthly_avg": _GOLD,
    "raw_monthly_avg_sorted": """
        WITH cents AS (
            SELECT strftime(o_orderdate, '%Y-%m') AS ym, o_orderpriority AS area_2, count(*) AS n,
                   CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS HUGEINT) AS total
            FROM orders GROUP BY 1, 2
        )
        SELECT ym, area_2, CAST((2 * total * 10000 + n) // (2 * n) AS DOUBLE) / 1000000 AS temp
        FROM cents ORDER BY 1, 3
    """,
    "silver_drop_rows": _SILVER_ROWS,
    "silver_violation_counts": _VIOLATIONS,
    "csv_batch_infer": _ALL_ROWS,
    "csv_view_monthly_avg": f"""
        SELECT ym, area_2, round(avg(temp), {DECIMALS}) AS temp
        FROM ({_OBSERVATIONS_SQL}) GROUP BY ym, area_2
    """,
    "csv_stream_bronze": _ALL_ROWS,
    "csv_merge_headers": f"""
        SELECT CAST(o.event_id AS VARCHAR) AS event_id, o.ymd, o.area_1, o.area_2, o.temp,
               CASE WHEN o.area_2 = 'purchase' AND o.event_id % 3 = 0 THEN e.props || chr(10) || e.props
                    WHEN o.area_2 = 'purchase' THEN e.props END AS props,
               CAST(NULL AS VARCHAR) AS _bad_record
        FROM ({_OBSERVATIONS_SQL}) o JOIN events e USING (event_id)
        UNION ALL VALUES ('10000000000000000000', '2024-01-01', 1, 'view', 1.5, NULL, NULL),
                         ('-1', '2024-01-01', 2, 'view', NULL, NULL, '-1,2024-01-01,2,view,n/a')
    """,
    "stream_silver_from_bronze": _SILVER_ROWS,
    "stream_violation_counts": _VIOLATIONS,
    "gold_after_streams": _GOLD,
    "gold_from_new_rows": _GOLD,
    "silver_counts_observed": f"{_VIOLATIONS} UNION ALL SELECT 'rows kept', count(*) FILTER ({_KEPT}) FROM ({_OBSERVATIONS_SQL})",
    "gold_stateful_stream": _GOLD,
}
