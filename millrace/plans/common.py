"""Shared by the plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from millrace.workspace import fresh_dir

_built: dict[tuple[str, str, str], str] = {}


def built_once(spark: SparkSession, sf_dir: str, label: str, build: Callable[[str], None]) -> str:
    """Path of a table derived from the supplied ones, built by the first query that needs it."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _built:
        path = fresh_dir(spark, label)
        build(path)
        _built[key] = path
    return _built[key]


def stored_path(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Path of a table that has been built."""
    return _built[spark.sparkContext.applicationId, sf_dir, label]
