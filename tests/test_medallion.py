"""CSV ingest and the bronze, silver, gold chain."""

from __future__ import annotations

from random import Random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from millrace.operators.aggregates import average_of_totals, monthly_average, monthly_totals
from millrace.operators.quality import Constraint
from millrace.sources.csv import (
    csv_layouts,
    csv_view,
    list_files,
    merge_schemas,
    read_csv_directory,
    read_csv_merging,
    reading,
    wider_type,
)
from millrace.session import session_with
from millrace.sources import quoted_csv
from millrace.sources.quoted_csv import ends_inside, inferred_types, parsed, quoted_records
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
from tests.conftest import rows

TEMPERATURE = "平均気温（℃）計測値"
CONSTRAINTS = (Constraint("day", "ymd IS NOT NULL"), Constraint("area", "area_2 IS NOT NULL"))


BAD = ("_bad_record", "string")


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_types_and_multi_byte_column_names_are_inferred(spark, tmp_path):
    put(tmp_path / "in", "a.csv", f"ymd,area_2,{TEMPERATURE}\n2024-01-02,x,1.5\n2024-01-03,,2\n")
    frame = read_csv_directory(spark, str(tmp_path / "in"))
    assert frame.dtypes == [("ymd", "date"), ("area_2", "string"), (TEMPERATURE, "double")]
    csv_view(spark, "observed", str(tmp_path / "in"))
    assert spark.sql(f"SELECT avg(`{TEMPERATURE}`) AS t FROM observed").first().t == 1.75


def test_two_rounds_take_in_new_files_only(spark, tmp_path):
    folder = tmp_path / "in"
    bronze, silver, log, totals = (str(tmp_path / n) for n in ("bronze", "silver", "log", "totals"))
    checkpoints = {n: str(tmp_path / f"{n}-checkpoint") for n in ("bronze", "silver", "log", "totals")}
    schema = f"ymd date, area_2 string, `{TEMPERATURE}` double"

    def run():
        run_bronze(spark, str(folder), schema, bronze, checkpoints["bronze"])
        run_silver(spark, bronze, silver, checkpoints["silver"], CONSTRAINTS)
        run_violation_log(spark, bronze, log, checkpoints["log"], CONSTRAINTS)
        run_totals_log(spark, silver, totals, checkpoints["totals"], "ymd", "area_2", TEMPERATURE)

    put(folder, "a.csv", f"ymd,area_2,{TEMPERATURE}\n2024-01-02,x,1\n2024-01-03,,2\n")
    run()
    assert spark.read.parquet(bronze).count() == 2 and spark.read.parquet(silver).count() == 1
    put(folder, "b.csv", f"ymd,area_2,{TEMPERATURE}\n2024-01-09,x,4\n,x,9\n2024-02-01,x,7\n")
    run()
    run()
    assert spark.read.parquet(bronze).count() == 5 and spark.read.parquet(silver).count() == 3
    assert rows(total_violations(spark, log)) == [("area", 1), ("day", 1)]
    gold = monthly_average(spark.read.parquet(silver), "ymd", "area_2", TEMPERATURE)
    assert rows(gold) == [("2024-01", "x", 2.5), ("2024-02", "x", 7.0)]
    assert rows(gold_from_totals(spark, totals)) == rows(gold)


def test_month_of_dates_and_timestamps(spark):
    frame = spark.sql(
        "SELECT timestamp'2024-12-31 23:59:59' AS t, timestamp_ntz'2025-01-01 00:00:00' AS n, date'2023-02-28' AS d, 'a' AS area, 1.0D AS v"
    )
    assert [monthly_average(frame, c, "area", "v").first().ym for c in "tnd"] == ["2024-12", "2025-01", "2023-02"]


def test_averages_of_totals_skip_nulls(spark):
    frame = spark.sql(
        "SELECT * FROM VALUES (date'2024-01-05', 'x', 1.0D), (date'2024-01-06', 'x', NULL), (date'2024-01-07', 'y', NULL) AS t(d, a, v)"
    )
    totals = monthly_totals(frame.limit(0), "d", "a", "v").union(monthly_totals(frame, "d", "a", "v"))
    assert rows(average_of_totals(totals)) == rows(monthly_average(frame, "d", "a", "v"))
    assert rows(average_of_totals(totals)) == [("2024-01", "x", 1.0), ("2024-01", "y", None)]


def test_a_column_named_area_is_not_mistaken_for_the_alias(spark):
    frame = spark.sql("SELECT date'2024-01-01' AS ymd, 'wrong' AS area, 'right' AS area_2, 3.0D AS v")
    assert rows(monthly_average(frame, "ymd", "area_2", "v")) == [("2024-01", "right", 3.0)]


def test_wrong_header_order_fails_in_the_plain_stream(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        run_bronze(spark, str(tmp_path / "in"), "a int, b int", str(tmp_path / "out"), str(tmp_path / "checkpoint"))


def test_files_with_different_headers_merge_by_name(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.csv", "a,b\n1,x\n")
    put(folder, "b.csv", "b,a\ny,2\n")
    put(folder / "deep", "c.csv", '"b","a","c"\r\n"z, z",3.5,2024-01-01\r\n')
    put(folder, "empty.csv", "")
    layouts = csv_layouts(list_files(spark, str(folder)))
    assert [layout.columns for layout in layouts] == [("a", "b"), ("b", "a"), ("b", "a", "c")]
    merged = read_csv_merging(spark, str(folder))
    assert merged.dtypes == [("a", "double"), ("b", "string"), ("c", "date"), BAD]
    assert [(r.a, r.b, str(r.c)) for r in merged.orderBy("a").collect()] == [
        (1.0, "x", "None"),
        (2.0, "y", "None"),
        (3.5, "z, z", "2024-01-01"),
    ]


def test_names_with_spaces_and_multi_byte_paths(spark, tmp_path):
    put(tmp_path / "in dir", "天気 1%20#.csv", "a\n1\n")
    assert rows(read_csv_merging(spark, str(tmp_path / "in dir"))) == [(1, None)]


def test_ingest_follows_growing_headers_and_wider_numbers(spark, tmp_path):
    folder, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    put(folder, "a.csv", "a,b\n1,x\n")
    ingest_csv(spark, str(folder), table, checkpoint)
    ingest_csv(spark, str(folder), table, checkpoint)
    assert rows(read_ingested(spark, table)) == [(1, "x", None)]
    put(folder, "b.csv", "c,b,a\n9,y,30000000000\n")
    ingest_csv(spark, str(folder), table, checkpoint)
    put(folder, "c.csv", "a,b\n2.5,z\n")
    ingest_csv(spark, str(folder), table, checkpoint)
    merged = read_ingested(spark, table)
    assert merged.dtypes == [("a", "double"), ("b", "string"), ("c", "int"), BAD]
    assert rows(merged) == [(1.0, "x", None, None), (2.5, "z", None, None), (30000000000.0, "y", 9, None)]


def test_rows_that_do_not_fit_keep_their_line(spark, tmp_path):
    folder, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    put(folder, "a.csv", "a,b\n1,x\n")
    ingest_csv(spark, str(folder), table, checkpoint)
    put(folder, "b.csv", "a,b\nword,y\n2,z\n")
    ingest_csv(spark, str(folder), table, checkpoint)
    assert rows(read_ingested(spark, table)) == [(1, "x", None), (2, "z", None), (None, "y", "word,y")]


def test_blank_first_lines_line_breaks_in_cells_and_wide_numbers(spark, tmp_path):
    folder, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    put(folder, "a.csv", "\n\na,b\n1,x\n")
    put(folder, "b.csv", 'a,b\n12345678901234567890,"two\nlines"\n')
    put(folder, "c.csv", "\n\n")
    ingest_csv(spark, str(folder), table, checkpoint)
    taken = read_ingested(spark, table)
    assert taken.dtypes[0] == ("a", "decimal(20,0)")
    assert sorted((str(r.a), r.b) for r in taken.collect()) == [("1", "x"), ("12345678901234567890", "two\nlines")]
    assert read_csv_merging(spark, str(folder)).count() == 2


def test_bronze_keeps_the_line_of_a_bad_cell(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "a,b\n1,2.5\n2,n/a\n")
    run_bronze(spark, str(tmp_path / "in"), "a int, b double", str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(1, 2.5, None), (2, None, "2,n/a")]


def test_a_column_without_values_has_no_say_in_its_type(spark, tmp_path):
    folder, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    put(folder, "a.csv", "a,b\n1,x\n")
    ingest_csv(spark, str(folder), table, checkpoint)
    put(folder, "b.csv", "a,b\n")
    put(folder, "c.csv", "b,a,c\ny,,\n")
    ingest_csv(spark, str(folder), table, checkpoint)
    merged = read_ingested(spark, table)
    assert merged.dtypes == [("a", "int"), ("b", "string"), ("c", "string"), BAD]
    assert rows(merged) == [(1, "x", None, None), (None, "y", None, None)]


def test_ingest_in_small_batches_is_whole(spark, tmp_path):
    folder, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    for i in range(5):
        put(folder, f"{i}.csv", f"a\n{i}\n")
    ingest_csv(spark, str(folder), table, checkpoint, files_per_batch=2)
    assert rows(read_ingested(spark, table)) == [(i, None) for i in range(5)]


def test_type_merging():
    int_, long_, double_, text = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert wider_type(int_, long_) == long_ and wider_type(double_, long_) == double_
    assert wider_type(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert wider_type(int_, T.DateType()) == text
    assert wider_type(long_, T.DecimalType(20, 0)) == T.DecimalType(20, 0)
    assert wider_type(T.DecimalType(20, 2), long_) == T.DecimalType(21, 2) and wider_type(T.DecimalType(20, 0), double_) == double_
    left = T.StructType([T.StructField("a", int_), T.StructField("b", text)])
    right = T.StructType([T.StructField("c", text), T.StructField("a", double_)])
    assert [(f.name, f.dataType) for f in merge_schemas(left, right)] == [("a", double_), ("b", text), ("c", text)]


def test_silver_counts_what_it_drops_in_the_same_pass(spark, tmp_path):
    bronze, silver, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "checkpoint"))
    schema = f"ymd date, area_2 string, `{TEMPERATURE}` double"

    def add(*lines):
        spark.createDataFrame([(None, a, t) for a, t in lines], schema).write.mode("append").parquet(bronze)

    add(("x", 1.0), (None, 2.0), ("y", 3.0))
    one_file_at_a_time = 1
    assert run_silver(spark, bronze, silver, checkpoint, CONSTRAINTS, one_file_at_a_time) == {"day": 3, "area": 1}
    assert run_silver(spark, bronze, silver, checkpoint, CONSTRAINTS) == {"day": 0, "area": 0}
    add((None, None))
    assert run_silver(spark, bronze, silver, checkpoint, CONSTRAINTS) == {"day": 1, "area": 1}
    assert spark.read.parquet(silver).count() == 0


def test_state_of_a_stream_equals_the_batch_result_after_each_round(spark, tmp_path):
    silver, gold, checkpoint = (str(tmp_path / n) for n in ("silver", "gold", "checkpoint"))
    lines = [("2024-01-05", "x", 1.0), ("2024-01-06", "x", 2.0), ("2024-02-01", None, None), (None, "y", 4.0)]
    for round_ in (lines, [("2024-01-07", "x", 6.0), ("2024-03-01", "z", -1.0)], []):
        frame = spark.createDataFrame(round_, f"ymd string, area_2 string, `{TEMPERATURE}` double")
        frame.selectExpr("cast(ymd AS date) AS ymd", "area_2", f"`{TEMPERATURE}`").write.mode("append").parquet(silver)
        run_gold(spark, silver, gold, checkpoint, "ymd", "area_2", TEMPERATURE, files_per_batch=1)
        expected = monthly_average(spark.read.parquet(silver), "ymd", "area_2", TEMPERATURE)
        assert rows(current_gold(spark, gold)) == rows(expected)


CELLS = ["plain", 'a "quoted" one', "two\nlines", 'br\n\n"x",\n,y', "back\\slash", '5" pipe', "", "ends with \\", "cr\r\nlf", None]


def test_one_file_with_quoted_breaks_is_read_by_many_tasks(spark, tmp_path):
    random = Random(4)
    data = [(i, random.choice([*CELLS, "long " * random.randint(0, 300) + '\n"']), random.random()) for i in range(1500)]
    spark.createDataFrame(data, "i int, t string, d double").coalesce(1).write.option("header", True).csv(str(tmp_path / "in"))
    small = session_with(spark, {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"})
    paths = [str(p) for p in (tmp_path / "in").glob("*.csv")]
    assert len(paths) == 1 and small.read.option("lineSep", "\n").text(paths).rdd.getNumPartitions() > 30
    schema = T.StructType.fromDDL("i int, t string, d double, _bad_record string")
    whole = spark.read.schema(schema).options(**reading(True)).csv(paths)
    records = quoted_records(small, paths)
    assert rows(parsed(records, schema, "_bad_record")) == rows(whole)
    assert inferred_types(small, records, ("i", "t", "d")) == T.StructType.fromDDL("i int, t string, d double")
    assert rows(read_csv_merging(small, str(tmp_path / "in"))) == rows(whole)
    some_named = quoted_csv.NAMED_SPLITS
    quoted_csv.NAMED_SPLITS = 0  # more splits begin inside a cell than may be named to every task
    assert rows(parsed(quoted_records(small, paths), schema, "_bad_record")) == rows(whole)
    quoted_csv.NAMED_SPLITS = some_named


def test_odd_quoted_files(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "\ufeff\r\n\r\nx,y\r\n1,\"a\nb\"\r\n\r\n2,\"open\n to the end")
    put(tmp_path / "in", "b.csv", "x,y\n")
    put(tmp_path / "in", "c.csv", "")
    frame = read_csv_merging(spark, str(tmp_path / "in"))
    assert rows(frame.select("x", "y")) == [(1, "a\nb"), (2, "open\n to the end")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='",\\a ', max_size=8), min_size=1, max_size=5), st.booleans())
def test_quotes_line_by_line_as_in_one_go(lines, inside):
    state = inside
    for line in lines[:-1]:
        state = ends_inside(line, state)
        if not state:
            break
    else:
        joined = "\n".join(lines)
        if not (any(line.endswith("\\") for line in lines)):
            assert ends_inside(joined, inside) == ends_inside(lines[-1], state)
