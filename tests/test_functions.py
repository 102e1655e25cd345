"""Keys, hashes, identifiers, arg-max."""

from __future__ import annotations

import random
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.arrays import argmax, argmax_in_pandas
from millrace.functions.hashing import fnv_hash_int4, fnv_hash_int8, fnv_hash_str, fnv_hash_str_native
from millrace.functions.identifiers import uuid5_url
from millrace.functions.keys import derived_key
from millrace.functions.register import register_functions


def fnv(data: bytes) -> int:
    value = 0xCBF29CE484222325
    for byte in data:
        value = ((value ^ byte) * 0x100000001B3) % 2**64
    return value - 2**64 if value >= 2**63 else value


def int_hash(value: int, width: int) -> int:
    return fnv((value % 2 ** (8 * width)).to_bytes(width, "little"))


def one(spark, values, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame([(v,) for v in values], schema).select(*columns).collect()]


def test_known_hash_values(spark):
    ints = one(spark, [0, 123, 2147483647, -1, None], "v int", fnv_hash_int4(F.col("v")))
    assert [r[0] for r in ints] == [
        5558979605539197941,
        -1444032211190476738,
        -7399706223028117551,
        -7399565485539706543,
        None,
    ]
    texts = one(spark, ["", "a", "あいう", None], "v string", fnv_hash_str("v"), fnv_hash_str_native(F.col("v")))
    expected = [-3750763034362895579, -5808556873153909620, -3983525269350834705, None]
    assert texts == [(e, e) for e in expected]


def test_integer_hashes_of_random_and_boundary_values(spark):
    random.seed(7)
    small = [0, 1, -1, 2**31 - 1, -(2**31), *(random.randint(-(2**31), 2**31 - 1) for _ in range(500))]
    large = [0, 1, -1, 2**63 - 1, -(2**63), *(random.randint(-(2**63), 2**63 - 1) for _ in range(500))]
    assert [r[0] for r in one(spark, small, "v int", fnv_hash_int4(F.col("v")))] == [int_hash(v, 4) for v in small]
    assert [r[0] for r in one(spark, large, "v bigint", fnv_hash_int8(F.col("v")))] == [int_hash(v, 8) for v in large]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.one_of(st.none(), st.text(max_size=60)), min_size=1, max_size=40))
def test_text_hashes(spark, texts):
    expected = [None if t is None else fnv(t.encode("utf-8", "surrogatepass")) for t in texts]
    found = one(spark, texts, "v string", fnv_hash_str("v"), fnv_hash_str_native(F.col("v")))
    assert found == [(e, e) for e in expected]


def test_text_hash_of_a_long_text_next_to_short_ones(spark):
    texts = ["x", "word " * 40_000, "", "yz"]
    assert [r[0] for r in one(spark, texts, "v string", fnv_hash_str("v"))] == [fnv(t.encode()) for t in texts]


def test_text_hashes_of_a_batch_with_a_long_tail(spark):
    random.seed(11)
    texts = ["ab" * random.randint(0, 40) for _ in range(300)] + ["é" * n for n in range(0, 4000, 97)] + [None] * 20
    random.shuffle(texts)
    frame = spark.createDataFrame([(t,) for t in texts], "v string").coalesce(1)
    found = [r[0] for r in frame.select(fnv_hash_str("v")).collect()]
    assert found == [None if t is None else fnv(t.encode()) for t in texts]


def test_hashes_from_sql(spark):
    register_functions(spark)
    row = spark.sql("SELECT fnv_hash_int4(123), fnv_hash_int8(123L), fnv_hash_str('a'), fnv_hash_int8(NULL)").first()
    assert tuple(row) == (-1444032211190476738, int_hash(123, 8), -5808556873153909620, None)


def test_integer_hash_stays_in_generated_code(spark):
    from tests.conftest import physical_plan

    plan = physical_plan(spark.range(10).select(fnv_hash_int8(F.col("id"))))
    assert "Python" not in plan and "codegen id" in plan


def test_key_format(spark):
    keys = one(spark, [0, 12, 123456789012, None], "v bigint", derived_key("orderkey_", F.col("v")))
    assert [k[0] for k in keys] == ["orderkey_0000000000", "orderkey_0000000012", "orderkey_1234567890", None]


def test_key_function_in_sql_takes_numbers_and_filters(spark):
    register_functions(spark)
    spark.range(20).createOrReplaceTempView("numbers")
    found = spark.sql("SELECT id FROM numbers WHERE sample_udf('k_', id) = 'k_0000000012'").collect()
    assert [r.id for r in found] == [12]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(names=st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=80), min_size=1, max_size=40))
def test_uuid5(spark, names):
    found = one(spark, names, "v string", uuid5_url(F.col("v")))
    assert [r[0] for r in found] == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


def test_uuid5_known_value_and_null(spark):
    found = one(spark, ["http://x", None], "v string", uuid5_url(F.col("v")))
    assert [r[0] for r in found] == ["c059942f-567e-54eb-aeb5-5fd9830bce43", None]


@pytest.mark.parametrize("function", [argmax, argmax_in_pandas])
def test_argmax_takes_the_first_of_equals(spark, function):
    arrays = [[0.1, 0.7, 0.2], [0.5, 0.5], [0.0, 0.0, 0.0], [-3.0, -1.0]]
    found = one(spark, arrays, "v array<double>", function(F.col("v")))
    assert [r[0] for r in found] == [1, 0, 0, 1]
