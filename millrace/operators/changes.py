"""Change rows between two snapshots of a keyed table."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Change kinds.
INSERT = "insert"
DELETE = "delete"
BEFORE_UPDATE = "update_preimage"
AFTER_UPDATE = "update_postimage"


def _side(df: DataFrame, keys: tuple[str, ...], prefix: str, columns: list[str]) -> DataFrame:
    values = [(F.col(f"`{c}`") if c in df.columns else F.lit(None)).alias(f"{prefix}{c}") for c in columns]
    return df.select(*keys, *values, F.lit(True).alias(f"{prefix}_present"))


def snapshot_changes(before: DataFrame, after: DataFrame, *keys: str) -> DataFrame:
    """Rows of both snapshots that differ, with ``change_type``.

    A row only in ``after`` is an insert, one only in ``before`` a delete; a row whose values differ
    (null equals null) gives its old and its new form. ``keys`` identify a row within a snapshot and
    are never null. Both sides shuffle once on the keys, which are unique and so cannot be skewed;
    equal rows leave right after the join. A column that only one snapshot has is null in the other.
    """
    columns = [c for c in dict.fromkeys([*before.columns, *after.columns]) if c not in keys]
    joined = _side(before, keys, "b_", columns).join(_side(after, keys, "a_", columns), list(keys), "full_outer")

    def image(kind: str, prefix: str) -> Column:
        values = [F.col(f"`{prefix}{c}`").alias(c) for c in columns]
        return F.struct(F.lit(kind).alias("change_type"), *(F.col(k) for k in keys), *values)

    same = reduce(
        lambda left, right: left & right,
        (F.col(f"`b_{c}`").eqNullSafe(F.col(f"`a_{c}`")) for c in columns),
        F.lit(True),
    )
    added, removed = F.col("b__present").isNull(), F.col("a__present").isNull()
    images = (
        F.when(added, F.array(image(INSERT, "a_")))
        .when(removed, F.array(image(DELETE, "b_")))
        .otherwise(F.array(image(BEFORE_UPDATE, "b_"), image(AFTER_UPDATE, "a_")))
    )
    return joined.filter(added | removed | ~same).select(F.inline(images))


def changed_keys(before: DataFrame, after: DataFrame, key: str, digest: str) -> DataFrame:
    """``key`` and its change kind, from keys and digests alone.

    For wide rows: only two narrow columns are shuffled, and the rows themselves are read again for
    changed keys only.
    """
    both = before.select(key, F.col(digest).alias("_before")).join(
        after.select(key, F.col(digest).alias("_after")), key, "full_outer"
    )
    kind = (
        F.when(F.col("_before").isNull(), INSERT)
        .when(F.col("_after").isNull(), DELETE)
        .when(F.col("_before") != F.col("_after"), AFTER_UPDATE)
    )
    return both.select(key, kind.alias("change_type")).filter(F.col("change_type").isNotNull())


# Buckets of keys in a stored snapshot: digests are compared per bucket, and files are pruned by it.
BUCKETS = 256


def store_snapshot(df: DataFrame, path: str, *keys: str, buckets: int = BUCKETS) -> None:
    """Write a snapshot in buckets of its keys, ``path/rows/bucket=<b>``, with a digest per bucket in ``path/digests``.

    A bucket's digest is made of its rows' hashes whatever their order: their number, two exclusive ors and a sum. It depends on
    the columns' names, so snapshots with different columns differ everywhere. The rows are read again from the
    written files for the digests, which are combined before the shuffle.
    """
    names = sorted(df.columns)
    bucket = F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in keys)), F.lit(buckets)).cast("int")
    placed = df.withColumn("bucket", bucket)
    # keys are unique, so buckets are even: a file each
    placed.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
    # nulls leave a hash unchanged, so which columns are null is hashed too
    nulls = F.concat(*[F.when(F.col(f"`{n}`").isNull(), "1").otherwise("0") for n in names], F.lit(",".join(names)))
    values = [*(F.col(f"`{n}`") for n in names), nulls]
    hashes = stored.select("bucket", F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(1), *reversed(values)).alias("b"))
    digests = hashes.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum((F.col("a") % (1 << 30))).alias("c")
    )
    digests.coalesce(1).write.parquet(f"{path}/digests")


def differing_buckets(spark: SparkSession, before: str, after: str) -> list[int]:
    """The buckets whose digests differ between two stored snapshots; a snapshot has a digest per bucket."""

    def digests(path: str, name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/digests").select("bucket", F.struct("rows", "a", "b", "c").alias(name))

    both = digests(before, "old").join(digests(after, "new"), "bucket", "full_outer")
    return sorted(r["bucket"] for r in both.filter(~F.col("old").eqNullSafe(F.col("new"))).select("bucket").collect())


def stored_snapshot(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a stored snapshot, or those of some buckets; the files of all other buckets are not read."""
    try:
        rows = spark.read.parquet(f"{path}/rows")
    except AnalysisException as error:  # a snapshot without rows has no files
        raise ValueError(f"no rows at {path}") from error
    return (rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))).drop("bucket")


def stored_snapshot_changes(spark: SparkSession, before: str, after: str, *keys: str) -> DataFrame:
    """:func:`snapshot_changes` of two stored snapshots, reading and joining only the buckets that differ."""
    buckets = differing_buckets(spark, before, after)
    return snapshot_changes(stored_snapshot(spark, before, buckets), stored_snapshot(spark, after, buckets), *keys)
