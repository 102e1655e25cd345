"""Written tables, parameters, statistics, previews, scratch folders."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
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
from millrace.operators.tables import (
    clustered,
    files_for,
    refresh_view,
    replace_catalog_table,
    replace_table,
    set_parameter,
    write_with_bloom_filters,
)
from millrace.sources.kafka import decode_json_records, kafka_options
from millrace.sources.tables import catalog_table, number_range, rows_in_memory, use_catalog
from millrace.workspace import fresh_dir, shared_root
from tests.conftest import physical_plan, rows


def file_ranges(path, column):
    found = []
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        for group in range(meta.num_row_groups):
            stats = meta.row_group(group).column(at).statistics
            found.append((stats.min, stats.max, meta.row_group(group).num_rows))
    return found


def test_clustered_files_hold_narrow_ranges(spark, tmp_path):
    frame = spark.range(40_000).select(((F.col("id") * 7919) % 40_000).alias("k"), F.lit("x").alias("v"))
    loose, tight = str(tmp_path / "loose"), str(tmp_path / "tight")
    replace_table(frame.repartition(8), loose)
    table = replace_table(clustered(frame, "k", files=8), tight)
    assert table.count() == 40_000

    def holding(path):
        return sum(low <= 777 <= high for low, high, _ in file_ranges(path, "k"))

    assert holding(tight) == 1 and holding(loose) == 8
    assert "EqualTo(k,777)" in physical_plan(table.filter("k = 777"))


def test_a_heavy_key_is_spread_over_several_files(spark, tmp_path):
    third = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    frame = spark.range(30_000).select(third.alias("k"), F.col("id").alias("v"))
    path = str(tmp_path / "heavy")
    replace_table(clustered(frame, "k", files=9), path)
    ranges = file_ranges(path, "k")
    assert sum(n for *_, n in ranges) == 30_000
    assert max(n for *_, n in ranges) < 6_000
    assert sum(low == -1 for low, *_ in ranges) >= 3


def test_number_of_files_follows_the_rows(spark):
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert files_for(spark, 10) == partitions
    assert files_for(spark, 10**12) == 250_000
    assert files_for(spark, 101, rows_per_file=10) == 11


def test_replacing(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    assert rows(replace_table(spark.range(1), path)) == [(0,)]
    replace_catalog_table(spark.range(3), "replaced", str(tmp_path / "c"))
    replace_catalog_table(spark.range(2).withColumn("x", F.lit(1)), "replaced", str(tmp_path / "c"), ("id",))
    use_catalog(spark, "spark_catalog")
    assert rows(catalog_table(spark, "spark_catalog.default.replaced")) == [(0, 1), (1, 1)]


def test_refreshing_a_view_from_itself(spark, tmp_path):
    refresh_view(spark.range(2), "counted", str(tmp_path / "1"))
    refresh_view(spark.table("counted").selectExpr("id + 1 AS id"), "counted", str(tmp_path / "2"))
    assert rows(spark.table("counted")) == [(1,), (2,)]


def test_parameters_in_sql(spark):
    session = spark.newSession()
    set_parameter(session, "DATA_BUCKET_NAME", "bucket")
    assert session.sql("SELECT 's3://${DATA_BUCKET_NAME}/data/' AS p").first().p == "s3://bucket/data/"
    session.sql("SET use_cached_result = false")


def test_ranges_and_rows_in_memory(spark):
    assert rows(number_range(spark, 3, 100)) == [(0,), (100,), (200,)]
    frame = rows_in_memory(spark, [(1.0, 2.0)], "f1 double, f2 double")
    assert frame.dtypes == [("f1", "double"), ("f2", "double")]


def test_preview_takes_the_first_by_key(spark):
    shown = preview(spark.range(100).repartition(5), "id", rows=3)
    assert rows(shown) == [(0,), (1,), (2,)] and "TakeOrderedAndProject" in physical_plan(shown)


def profile_sample(spark):
    return spark.createDataFrame(
        [(1, "あ", 1.5), (2, "bb", None), (2, None, -1.0), (None, "bb", 1.5)], "a int, b string, c double"
    )


def test_exact_profile(spark):
    found = {r.column_name: r for r in column_profile(profile_sample(spark), exact=True).collect()}
    a, b, c = found["a"], found["b"], found["c"]
    assert (a.rows, a.nulls, a.distinct_values, a.min_number, a.max_number, a.avg_len, a.max_len) == (4, 1, 2, 1, 2, 4, 4)
    assert (b.nulls, b.distinct_values, b.min_text, b.max_text, b.avg_len, b.max_len) == (1, 2, "bb", "あ", 2, 2)
    assert (c.nulls, c.distinct_values, c.min_number, c.max_number) == (1, 2, -1.0, 1.5)


def test_profile_of_no_rows_and_of_nulls_only(spark):
    for frame in (profile_sample(spark).limit(0), profile_sample(spark).select(F.lit(None).cast("string").alias("n"))):
        for exact in (False, True):
            assert {r.distinct_values for r in column_profile(frame, exact).collect()} == {0}


def test_estimates_are_close_and_need_one_pass(spark):
    frame = spark.range(20_000).select("id", (F.col("id") % 100).alias("few"))
    profile = column_profile(frame)
    found = {r.column_name: r.distinct_values for r in profile.collect()}
    assert abs(found["id"] / 20_000 - 1) < 0.1 and abs(found["few"] / 100 - 1) < 0.1
    plan = physical_plan(profile)
    assert plan.count("\n(1)") == 1 and "hashpartitioning" not in plan


def test_distinct_values_of_a_column_dominated_by_one_value(spark):
    third = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    frame = spark.range(9_000).select(third.alias("k"))
    assert rows(distinct_counts(frame)) == [("k", 6_001)]


def test_stored_statistics(spark, tmp_path):
    replace_catalog_table(profile_sample(spark), "profiled", str(tmp_path / "p"))
    analyze_table(spark, "profiled")
    found = {r.column_name: r for r in stored_statistics(spark, "profiled").collect()}
    assert (found["a"].nulls, found["a"].distinct_values, found["a"].min_value, found["a"].max_value) == ("1", "2", "1", "2")
    assert found["b"].min_value is None and found["b"].max_len == "2"


def test_scratch_folders_follow_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert first != second and first.startswith(shared_root(spark) + "/")



def test_kafka_options():
    connection = {"sasl.mechanism": "X", "kafka.security.protocol": "SASL_SSL"}
    expected = {
        "kafka.bootstrap.servers": "h:1",
        "kafka.sasl.mechanism": "X",
        "kafka.security.protocol": "SASL_SSL",
        "subscribe": "t",
        "startingOffsets": "earliest",
    }
    assert kafka_options("h:1", "t", connection) == expected
    assert kafka_options("h:1", "t", connection, bounded=True) == {**expected, "endingOffsets": "latest"}


def test_records_that_are_not_json_keep_their_place(spark):
    records = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b'{"a": 1}'), "t", 0, 5), (None, bytearray(b"oops"), "t", 1, 6)],
        "key binary, value binary, topic string, partition int, offset bigint",
    )
    assert rows(decode_json_records(records, "a int")) == [("k", 1, "t", 0, 5), (None, None, "t", 1, 6)]


def test_kafka_reader_without_its_connector_says_so(spark):
    from millrace.sources.kafka import read_topic, stream_topic

    for read in (read_topic, stream_topic):
        with pytest.raises(Exception, match="(?i)kafka"):
            read(spark, "h:1", "t")


def test_statistics_of_appended_batches_equal_a_full_pass(spark, tmp_path):
    schema = "n int, t string, d double, flag boolean"
    batches = [
        [(i, f"t{i % 700}", i / 3, None) for i in range(3000)],
        [(None, None, None, None)],
        [(-5, "a longer text than all", float("-inf"), True), (7, "", 1.0, False)],
        [],
    ]
    path = str(tmp_path / "statistics")
    for batch in batches:
        append_statistics(spark.createDataFrame(batch, schema), path)
    whole = spark.createDataFrame([r for batch in batches for r in batch], schema)
    merged = {r["column_name"]: r.asDict() for r in merged_statistics(spark, path, (0.0, 0.5, 1.0)).collect()}
    for exact in column_profile(whole, exact=True).collect():
        own = merged[exact["column_name"]]
        assert {k: own[k] for k in own if k not in ("distinct_values", "quantiles")} == {
            k: v for k, v in exact.asDict().items() if k != "distinct_values"
        }
        assert abs(own["distinct_values"] - exact["distinct_values"]) <= 0.04 * exact["distinct_values"]
    low, middle, high = merged["n"]["quantiles"]
    assert low == -5 and high == 2999 and abs(middle - 1500) < 60 and merged["t"]["quantiles"] is None


def test_bloom_filters_skip_row_groups_of_a_column_without_layout(spark, tmp_path):
    frame = spark.range(200_000).selectExpr("id", "concat('key', pmod(xxhash64(id), 1000000)) AS k").repartition(8)
    wanted = frame.filter("id = 777").first()["k"]

    def read_rows(table):
        found = table.filter(F.col("k") == wanted)
        assert 777 in {r.id for r in found.collect()}
        plan = found._jdf.queryExecution().executedPlan()
        return plan.collectLeaves().head().metrics().apply("numOutputRows").value()

    plain = frame.write.parquet(str(tmp_path / "plain"))
    assert plain is None and read_rows(spark.read.parquet(str(tmp_path / "plain"))) == 200_000
    assert read_rows(write_with_bloom_filters(frame, str(tmp_path / "bloom"), {"k": 50_000})) < 60_000
