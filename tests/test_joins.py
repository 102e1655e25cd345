"""Joins: results, and the plans that make them scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from millrace.functions.keys import FILTER_KEY_PREFIX, derived_key
from millrace.operators.joins import (
    anti_join,
    check_key_space,
    join_left_columns,
    replicate,
    semi_join,
    semi_join_pruned,
)
from millrace.operators.statistics import analyze_table
from millrace.operators.tables import replace_catalog_table
from millrace.plans import order_joins
from millrace.session import session_with
from millrace.workspace import fresh_dir
from tests.conftest import physical_plan, printed_plan, rows

FOLDER = "/root/testdata/sf0.001"
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def left(spark):
    return spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")


def right(spark):
    return spark.createDataFrame([("a", 9), ("a", 8), ("c", 7), (None, 6)], "k string, w int")


def test_inner_repeats_and_semi_does_not(spark):
    assert rows(join_left_columns(left(spark), right(spark), "k")) == [("a", 1), ("a", 1), ("a", 2), ("a", 2)]
    assert rows(semi_join(left(spark), right(spark), "k")) == [("a", 1), ("a", 2)]
    assert rows(semi_join_pruned(left(spark), right(spark), "k")) == [("a", 1), ("a", 2)]
    assert rows(semi_join_pruned(left(spark), right(spark).limit(0), "k")) == []
    assert rows(anti_join(left(spark), right(spark), "k")) == [("b", 3), (None, 4)]


def test_pruned_semi_join_is_a_join_behind_a_range(spark):
    plan = physical_plan(semi_join_pruned(left(spark), right(spark), "k"))
    assert "LeftSemi" in plan and ">= a" in plan and "<= c" in plan


@pytest.mark.parametrize("strategy,node", [("shuffle_hash", "ShuffledHashJoin"), ("merge", "SortMergeJoin")])
def test_strategies_give_the_same_rows(spark, strategy, node):
    session = session_with(spark, NO_BROADCAST)
    joined = join_left_columns(left(session), right(session), "k", strategy)
    assert node in physical_plan(joined)
    assert rows(joined) == rows(join_left_columns(left(spark), right(spark), "k"))


def test_replicas(spark):
    copies = replicate(spark.createDataFrame([(5,)], "k bigint"), 3, 100)
    assert copies.columns == ["k", "id"] and rows(copies) == [(5, 0), (5, 100), (5, 200)]
    plan = physical_plan(copies)
    assert "Join" not in plan and "Exchange" not in plan


def test_key_space(spark):
    frame = spark.createDataFrame([(1,), (99,)], "k bigint")
    check_key_space(frame, "k", 10, 100, 3)
    with pytest.raises(ValueError):
        check_key_space(frame, "k", 2, 99, 3)
    with pytest.raises(ValueError):
        check_key_space(frame, "k", 11, 100, 3)
    check_key_space(frame.limit(0), "k", 11, 100, 1)


def test_computed_filter_finds_every_copy(spark):
    """The computed key has no copy offset, so it is another question than the stored key."""
    stored = order_joins.join_table_table(spark, FOLDER).count()
    assert order_joins.join_computed_filter(spark, FOLDER).count() == order_joins.COPIES * stored


def test_stored_filter_is_pushed_and_computed_filter_is_not(spark):
    orders = order_joins.stored_orders(spark, FOLDER)
    stored = physical_plan(orders.filter(F.col("filter_pre") == order_joins.POINT))
    computed = physical_plan(orders.filter(derived_key(FILTER_KEY_PREFIX, F.col("o_orderkey")) == order_joins.POINT))
    assert f"EqualTo(filter_pre,{order_joins.POINT})" in stored
    assert "EqualTo" not in computed


def test_join_reads_two_columns_of_the_right_table(spark):
    plan = physical_plan(order_joins.join_planned_at_runtime(spark, FOLDER))
    assert "ReadSchema: struct<orderkey_pre:string,filter_pre:string>" in plan
    assert "BroadcastHashJoin" in plan


def test_joins_join(spark):
    for query in (order_joins.join_table_table, order_joins.join_table_copy, order_joins.join_view_copy, order_joins.join_computed_filter):
        assert "Join" in physical_plan(query(spark, FOLDER))


def test_point_lookup_reads_one_key(spark):
    plan = physical_plan(order_joins.semi_join_key_pushdown(spark, FOLDER))
    assert "GreaterThanOrEqual(orderkey_pre,orderkey_0000000012)" in plan and "LeftSemi" in plan


def test_output_table_is_replaced(spark):
    first, second = (order_joins.join_output_table(spark, FOLDER).count() for _ in range(2))
    assert first == second == order_joins.join_table_table(spark, FOLDER).count()


def test_statistics_make_the_planner_broadcast(spark):
    plan = physical_plan(order_joins.join_with_statistics(spark, FOLDER))
    assert "BroadcastHashJoin" in plan


def test_view_key_is_not_computed_when_unused(spark):
    lines = order_joins.lineitem_view(spark, FOLDER).select("l_quantity")
    assert "lpad" not in physical_plan(lines)


def test_bloom_filter_thins_the_probe_side(spark):
    plan = physical_plan(order_joins.join_bloom_filter(spark, FOLDER))
    assert "might_contain" in plan and "bloom_filter_agg" in plan and "ShuffledHashJoin" in plan


def test_copies_are_stored_without_shuffling_them(spark, monkeypatch):
    """The source is shuffled once; the copies are read from it file by file, and each stored file holds one copy's narrow range."""
    written = []
    replace = order_joins.replace_table
    monkeypatch.setattr(order_joins, "replace_table", lambda df, *a, **k: written.append((df, k.get("cluster_by"))) or replace(df, *a, **k))
    path = fresh_dir(spark, "copies")
    source = spark.createDataFrame([(k % 1000, float(k)) for k in range(4000)] + [(None, 1.0), (None, 1.0)], "l_orderkey bigint, v double")
    order_joins._stored_copies(spark, source, "l_orderkey", path, order_joins._keyed_lines)
    (_, by_key), (copies, not_again) = written
    assert by_key and not not_again
    assert "Exchange" not in physical_plan(copies) and "Sort" not in physical_plan(copies)
    stored = spark.read.parquet(path)
    assert rows(stored) == rows(order_joins._keyed_lines(replicate(source, order_joins.COPIES, order_joins.STRIDE)))
    files = stored.filter(f"{order_joins.KEY} is not null").groupBy(F.input_file_name()).agg(
        F.min(order_joins.KEY).alias("low"), F.max(order_joins.KEY).alias("high"), F.count_distinct("id").alias("copies")
    )
    ranges = sorted((r.low, r.high, r.copies) for r in files.collect())
    assert {r[2] for r in ranges} == {1}
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


@pytest.mark.parametrize(
    "name", ["join_table_table", "join_table_copy", "join_view_copy", "join_computed_filter", "join_planned_at_runtime", "semi_join_in",
             "semi_join_key_pushdown", "join_sql_text", "join_broadcast_checked"]
)
def test_large_sides_are_thinned_before_the_shuffle(spark, monkeypatch, name):
    """As if both tables were too large to broadcast: what is not asked for is filtered before it is shuffled."""
    real = order_joins.session_with
    monkeypatch.setattr(order_joins, "session_with", lambda s, settings: real(s, {**settings, "spark.sql.autoBroadcastJoinThreshold": "1"}))
    frame = getattr(order_joins, name)(spark, FOLDER)
    plan = physical_plan(frame)
    assert "might_contain" in plan and "bloom_filter_agg" in plan
    assert frame.count() > 0


def test_bloom_filter_is_sized_for_its_keys(spark):
    """A filter of the default size lets everything through when there are millions of keys."""
    session = order_joins._urgent_thinning(spark, FOLDER)
    keys = order_joins._urgent(order_joins.stored_orders(spark, FOLDER)).count()
    assert int(session.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits")) == 8 * keys
    assert "might_contain" in physical_plan(order_joins.join_sort_merge(spark, FOLDER))
    large = order_joins._thinning(spark, keys=10**9)
    assert int(large.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits")) == order_joins.FILTER_BITS


def test_in_subquery_becomes_a_semi_join(spark):
    left(spark).createOrReplaceTempView("l")
    right(spark).createOrReplaceTempView("r")
    plan = physical_plan(spark.sql("SELECT * FROM l WHERE k IN (SELECT k FROM r WHERE w > 7)"))
    assert "LeftSemi" in plan


def test_statistics_change_the_estimate(spark, tmp_path):
    """With column statistics the filtered right side is known to be small."""
    table = "estimated_orders"
    replace_catalog_table(order_joins.stored_orders(spark, FOLDER), table, str(tmp_path / table))

    def estimated_rows():
        frame = spark.table(table).filter(F.col("filter_pre") == order_joins.POINT)
        line = next(line for line in printed_plan(frame, "cost").splitlines() if "Filter" in line)
        found = re.search(r"rowCount=(\d+)", line)
        return int(found.group(1)) if found else None

    assert estimated_rows() is None
    analyze_table(spark, table)
    assert estimated_rows() <= 3


def test_a_key_with_a_third_of_all_rows(spark):
    """Split by the adaptive planner; the rows stay whole."""
    session = session_with(
        spark,
        {
            **NO_BROADCAST,
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        },
    )
    numbers = session.range(0, 60_000, 1, 8)
    heavy = numbers.select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.uuid().alias("v"))
    keys = session.range(-1, 60_000).withColumnRenamed("id", "k")
    joined = join_left_columns(heavy, keys, "k", "merge")
    assert len(joined.collect()) == 60_000
    assert "skew=true" in printed_plan(joined, "simple")
