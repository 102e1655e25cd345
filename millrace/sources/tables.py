"""Catalog tables, path-addressed tables, number ranges and in-memory rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a table by its one-, two- or three-part name."""
    return spark.table(name)


def path_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Scan a table by its path, the ``FROM format.`path``` form."""
    return spark.sql(f"SELECT * FROM {format}.`{path}`")


def fixture(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the supplied tables: ``<folder>/<name>.parquet``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def number_range(spark: SparkSession, count: int, step: int = 1) -> DataFrame:
    """``id`` = 0, step, 2*step … with ``count`` rows."""
    return spark.range(count).select((F.col("id") * step).alias("id"))


def rows_in_memory(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A DataFrame of literal rows with a DDL schema."""
    return spark.createDataFrame(list(rows), schema=schema)


def use_catalog(spark: SparkSession, catalog: str) -> None:
    """Switch the current catalog. (``USE CATALOG`` is not part of open-source Spark SQL.)"""
    spark.catalog.setCurrentCatalog(catalog)
