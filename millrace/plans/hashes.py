"""FNV hashes of names and numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.hashing import fnv_hash_int4, fnv_hash_int8, fnv_hash_str, fnv_hash_str_native
from millrace.functions.register import register_functions
from millrace.sources.tables import fixture


def fnv_str(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fixture(spark, sf_dir, "customer")
    return customers.select("c_custkey", fnv_hash_str("c_name").alias("hash"))


def fnv_str_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fixture(spark, sf_dir, "customer")
    return customers.select("c_custkey", fnv_hash_str_native(customers.c_name).alias("hash"))


def fnv_str_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "documents").select("doc_id", fnv_hash_str("text").alias("hash"))


def fnv_int4(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fixture(spark, sf_dir, "part")
    return parts.select("p_partkey", fnv_hash_int4(parts.p_size).alias("hash"))


def fnv_int8(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixture(spark, sf_dir, "orders")
    return orders.select("o_orderkey", fnv_hash_int8(orders.o_orderkey).alias("hash"))


def fnv_from_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    fixture(spark, sf_dir, "customer").createOrReplaceTempView("customers_to_hash")
    return spark.sql("""
        SELECT c_custkey, fnv_hash_str(c_name) AS name_hash, fnv_hash_int4(c_nationkey) AS nation_hash,
               fnv_hash_int8(c_custkey) AS key_hash
        FROM customers_to_hash
    """)


QUERIES = {
    "fnv_str": fnv_str,
    "fnv_str_native": fnv_str_native,
    "fnv_str_documents": fnv_str_documents,
    "fnv_int4": fnv_int4,
    "fnv_int8": fnv_int8,
    "fnv_from_sql": fnv_from_sql,
}


def _fold(byte_list: str) -> str:
    """FNV-1a over a list of byte values in 128-bit arithmetic, then read as signed."""
    unsigned = (
        f"list_reduce({byte_list}, lambda h, b: (xor(h, b) * 1099511628211::UHUGEINT) "
        "% 18446744073709551616::UHUGEINT, 14695981039346656037::UHUGEINT)"
    )
    return f"""CAST(CASE WHEN {unsigned} >= 9223372036854775808::UHUGEINT
        THEN CAST({unsigned} AS HUGEINT) - 18446744073709551616::HUGEINT
        ELSE CAST({unsigned} AS HUGEINT) END AS BIGINT)"""


def _int_bytes(column: str, width: int) -> str:
    entries = ", ".join(f"(({column} >> {8 * i}) & 255)::UHUGEINT" for i in range(width))
    return f"[{entries}]"


def _text_bytes(column: str) -> str:
    return (
        f"list_transform(regexp_extract_all(hex(encode({column})), '..'), lambda x: (('0x' || x)::INT)::UHUGEINT)"
    )


ORACLES = {
    "fnv_str": f"SELECT c_custkey, {_fold(_text_bytes('c_name'))} AS hash FROM customer",
    "fnv_str_native": f"SELECT c_custkey, {_fold(_text_bytes('c_name'))} AS hash FROM customer",
    "fnv_str_documents": f"SELECT doc_id, {_fold(_text_bytes('text'))} AS hash FROM documents",
    "fnv_int4": f"SELECT p_partkey, {_fold(_int_bytes('p_size', 4))} AS hash FROM part",
    "fnv_int8": f"SELECT o_orderkey, {_fold(_int_bytes('o_orderkey', 8))} AS hash FROM orders",
    "fnv_from_sql": f"""
        SELECT c_custkey, {_fold(_text_bytes('c_name'))} AS name_hash,
               {_fold(_int_bytes('c_nationkey', 4))} AS nation_hash, {_fold(_int_bytes('c_custkey', 8))} AS key_hash
        FROM customer
    """,
}
