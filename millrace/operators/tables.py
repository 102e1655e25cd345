"""Writing tables: replace, cluster, refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Rows per file of a clustered table: a few hundred MB of ordinary rows.
ROWS_PER_FILE = 4_000_000


def files_for(spark: SparkSession, rows: int, rows_per_file: int = ROWS_PER_FILE) -> int:
    """How many files a clustered table of ``rows`` rows gets, at least one per shuffle partition.

    Range partitions are not split at run time, so for a large table their number follows its size
    and not the session's setting.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_file))


def clustered(df: DataFrame, *keys: str | Column, files: int | None = None) -> DataFrame:
    """Rows arranged so that each written file holds a narrow range of ``keys``.

    Range boundaries are drawn on the keys followed by a hash of the row. With the keys alone all
    rows of one key value would land in one task; with the hash a heavy value spreads over as many
    partitions as its share of the rows, still next to each other. The hash depends on the row only,
    so a task that is run again after a lost executor sends its rows to the same places.

    A key may be an expression with the wanted order. Zero-padded text keys sort like their numbers,
    and numbers compare much faster than text with a long common prefix.
    """
    order = [F.col(key) if isinstance(key, str) else key for key in keys]
    tie = F.xxhash64(*(F.col(f"`{name}`") for name in df.columns))
    ranges = [*order, tie]
    ranged = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    return ranged.sortWithinPartitions(*order)


def replace_table(
    df: DataFrame,
    path: str,
    cluster_by: tuple[str | Column, ...] = (),
    files: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Write ``df`` to ``path`` in place of what is there and return the table read back.

    ``options`` are those of the Parquet writer. ``df`` must not read from ``path``; to rewrite a table from itself write to a new path.
    """
    if cluster_by:
        df = clustered(df, *cluster_by, files=files)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_with_bloom_filters(df: DataFrame, path: str, distinct: dict[str, int], row_group_bytes: int = 128 << 20) -> DataFrame:
    """Write ``df`` with a Bloom filter per row group for each column of ``distinct`` and return the table read back.

    For equality lookups on columns that the table is not laid out by: their minimum and maximum say nothing, but the filter
    tells nearly all row groups that do not hold a value. ``distinct`` gives the expected number of values in a
    row group, which sets the filter's size (about 1.2 bytes a value).
    """
    writer = df.write.mode("overwrite").option("parquet.block.size", row_group_bytes)
    for column, values in distinct.items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", values)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_catalog_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    cluster_by: tuple[str | Column, ...] = (),
    files: int | None = None,
) -> DataFrame:
    """The same for a named table. With ``path`` its files live there instead of the warehouse."""
    if cluster_by:
        df = clustered(df, *cluster_by, files=files)
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def refresh_view(df: DataFrame, name: str, path: str) -> DataFrame:
    """Recompute a stored result and point the view ``name`` at it.

    Readers of the earlier version keep their files: give each refresh its own ``path``.
    """
    stored = replace_table(df, path)
    stored.createOrReplaceTempView(name)
    return stored


def set_parameter(spark: SparkSession, name: str, value: str) -> None:
    """Set a job parameter; SQL text refers to it as ``${name}``."""
    spark.conf.set(name, value)
