"""All SQL functions in one call."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.functions.hashing import register_hash_functions
from millrace.functions.keys import register_key_function


def register_functions(spark: SparkSession) -> None:
    """Register the key and hash functions for SQL text in this session."""
    register_key_function(spark)
    register_hash_functions(spark)
