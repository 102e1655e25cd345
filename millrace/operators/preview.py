"""Look at the first rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(df: DataFrame, *keys: str, rows: int = 10) -> DataFrame:
    """The first ``rows`` rows by ``keys``. Each partition keeps its own first rows, nothing is sorted whole."""
    return df.orderBy(*keys).limit(rows)
