"""Derived text keys: a prefix followed by a zero-padded number."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The key format the order and line-item tables share.
ORDER_KEY_PREFIX = "orderkey_"
FILTER_KEY_PREFIX = "filter_"
KEY_WIDTH = 10
SQL_KEY_FUNCTION = "sample_udf"


def derived_key(prefix: str, value: Column, width: int = KEY_WIDTH) -> Column:
    """``prefix || lpad(value, width, '0')``; a value longer than ``width`` is cut on the right."""
    return F.concat(F.lit(prefix), F.lpad(value.cast("string"), width, "0"))


def register_key_function(spark: SparkSession, name: str = SQL_KEY_FUNCTION) -> None:
    """Register the key format as a SQL function. Catalyst inlines its body into the calling plan."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(prefix STRING, val STRING) RETURNS STRING "
        f"RETURN prefix || lpad(val, {KEY_WIDTH}, '0')"
    )
