"""Equi-joins and semi-joins that return the left table's columns, and scale-out replication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replicate(df: DataFrame, copies: int, stride: int, id_name: str = "id") -> DataFrame:
    """Each row once per ``id`` = 0, stride, 2*stride …

    The same rows as a cross join with a number range, but generated where the row is: no join, no
    exchange.
    """
    offsets = F.array(*(F.lit(i * stride).cast("bigint") for i in range(copies)))
    return df.select(F.explode(offsets).alias(id_name), "*").select(*df.columns, id_name)


def check_key_space(df: DataFrame, key: str, copies: int, stride: int, width: int) -> None:
    """Fail when replicated keys would collide or no longer fit the padded width."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    if high is None:
        return
    if low < 0 or high >= stride or high + (copies - 1) * stride >= 10**width:
        raise ValueError(f"keys {low}..{high} do not fit {copies} copies {stride} apart in {width} digits")


def join_left_columns(left: DataFrame, right: DataFrame, key: str, strategy: str | None = None) -> DataFrame:
    """Inner join on ``key``, keeping the left columns.

    Without ``strategy`` the planner decides: it broadcasts the right side only when its size, from
    statistics or measured while running, is below ``spark.sql.autoBroadcastJoinThreshold``, and
    splits skewed partitions otherwise. ``shuffle_hash`` and ``merge`` ask for those strategies.
    """
    right_keys = right.select(key)
    if strategy:
        right_keys = right_keys.hint(strategy)
    return left.join(right_keys, key).select(left["*"])


def anti_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows whose key does not occur on the right."""
    return left.join(right.select(key), key, "left_anti")


def semi_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows whose key occurs on the right, each once: ``WHERE key IN (SELECT key …)``."""
    return left.join(right.select(key), key, "left_semi")


def semi_join_pruned(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """A semi-join that prunes the left scan to the range of the right side's keys.

    Open-source Spark derives scan filters from a join for partition columns only. The smallest and
    the largest key of the right side, one row, are fetched first and become a range filter on the
    left scan, which skips the row groups of a clustered table that lie outside. The join itself is
    the same at every size. Worth asking for when the right side's keys lie close together.
    """
    low, high = right.agg(F.min(key), F.max(key)).first()
    if low is None:
        return semi_join(left.filter(F.lit(False)), right, key)
    return semi_join(left.filter(F.col(key).between(low, high)), right, key)
