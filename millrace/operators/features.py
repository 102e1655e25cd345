"""Feature preparation: split, standardise, one-hot encode."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import session_with
from millrace.workspace import fresh_dir

# Bytes of a stored split's files that one task reads.
TASK_BYTES = 16 << 20


def row_bucket(*keys: Column, buckets: int = 100) -> Column:
    """A number below ``buckets`` that depends on the keys only.

    Taken from the MD5 digest of the keys' text, which every engine computes alike.
    """
    digest = F.md5(F.concat_ws("-", *(key.cast("string") for key in keys)))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def split_side(*keys: str, train_percent: int = 75) -> Column:
    """``train`` or ``test``. The same row lands on the same side in every run and partitioning."""
    return F.when(row_bucket(*(F.col(key) for key in keys)) < train_percent, "train").otherwise("test")


def split_by_key(df: DataFrame, *keys: str, train_percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """Training and test rows."""
    side = split_side(*keys, train_percent=train_percent)
    return df.filter(side == "train"), df.filter(side == "test")


def store_split(df: DataFrame, path: str, *keys: str, train_percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """Write the rows once, a folder per side, and return both sides read back.

    Fitting passes over the training rows many times; each pass then reads one narrow folder instead
    of the wide source with a digest per row. Row groups are small: a task reads whole ones, and fitting a forest holds
    their rows as objects of many times their size.
    """
    side = split_side(*keys, train_percent=train_percent)
    writer = df.withColumn("side", side).write.mode("overwrite").option("parquet.block.size", TASK_BYTES)
    writer.partitionBy("side").parquet(path)
    return read_split(df.sparkSession, path)


def read_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of a stored split, :data:`TASK_BYTES` of files a task."""
    stored = session_with(spark, {"spark.sql.files.maxPartitionBytes": str(TASK_BYTES)}).read.parquet(path)
    return tuple(stored.filter(F.col("side") == side).drop("side") for side in ("train", "test"))


@dataclass(frozen=True)
class Standardiser:
    """Means and population standard deviations of some columns."""

    means: dict[str, float]
    deviations: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> Standardiser:
        """One pass; a single row of numbers comes back to the driver."""
        row = df.agg(
            *(F.avg(c).alias(f"m_{c}") for c in columns),
            *(F.stddev_pop(c).alias(f"d_{c}") for c in columns),
        ).first()
        # a constant column is only centred
        return cls({c: row[f"m_{c}"] for c in columns}, {c: row[f"d_{c}"] or 1.0 for c in columns})

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace each column by its standardised value: plain column arithmetic with constants."""
        return df.withColumns({c: (F.col(c) - self.means[c]) / self.deviations[c] for c in self.means})


@dataclass(frozen=True)
class OneHot:
    """Sorted categories of a column and the way to and from 0/1 arrays."""

    categories: tuple

    @classmethod
    def fit(cls, df: DataFrame, column: str, max_categories: int = 10_000) -> OneHot:
        """Find the categories. An array per row has an entry per category, so their number is bounded."""
        values = df.select(column).filter(F.col(column).isNotNull()).distinct()
        found = [row[0] for row in values.limit(max_categories + 1).collect()]
        if len(found) > max_categories:
            raise ValueError(f"{column} has more than {max_categories} categories")
        return cls(tuple(sorted(found)))

    def transform(self, column: Column) -> Column:
        """0/1 array with one entry per category; a value that was not seen in ``fit`` is an error."""
        entries = F.array(*(F.when(column == F.lit(c), 1.0).otherwise(0.0) for c in self.categories))
        unseen = F.raise_error(F.concat(F.lit("unknown category: "), F.coalesce(column.cast("string"), F.lit("null"))))
        known = F.coalesce(column.isin(*self.categories), F.lit(False))
        return F.when(known, entries).otherwise(unseen)

    def inverse(self, encoded: Column) -> Column:
        """The category of the largest entry; all zeros give null."""
        position = F.array_position(encoded, F.array_max(encoded)).cast("int")
        labels = F.array(*(F.lit(c) for c in self.categories))
        return F.when(F.array_max(encoded) > 0, F.element_at(labels, position))


def category_table(df: DataFrame, column: str) -> DataFrame:
    """``(category, index)``: the sorted categories of a column, any number of them, numbered from 0; written and read back.

    Sorted by ranges over all tasks: a category's number is its place in its part plus what the parts before it hold.
    """
    spark, ordered, path = df.sparkSession, fresh_dir(df.sparkSession, "categories-sorted"), fresh_dir(df.sparkSession, "categories")
    values = df.select(F.col(column).alias("category")).filter(F.col("category").isNotNull()).distinct()
    values = values.repartitionByRange("category").sortWithinPartitions("category")
    values.withColumn("at", F.monotonically_increasing_id()).write.parquet(ordered)
    stored = spark.read.parquet(ordered).withColumn("part", F.shiftright("at", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    parts = stored.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    parts = parts.select("part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    numbered = stored.join(parts, "part").select("category", (F.col("at") - F.col("first") + F.col("earlier")).alias("index"))
    numbered.write.parquet(path)
    return spark.read.parquet(path)


def sparse_one_hot(df: DataFrame, column: str, categories: DataFrame, output: str) -> DataFrame:
    """``df`` with ``output``, a sparse 0/1 vector ``(size, indices, values)`` by the category's number.

    Rows meet the category table in a join, so neither the number of categories nor a category that fills a third of the rows
    matters; the planner sends a small table to all tasks. A null or unknown category has no entry.
    """
    size = categories.count()
    known = categories.select(F.col("category").alias("_category"), F.col("index").alias("_index"))
    joined = df.join(known, F.col(column) == F.col("_category"), "left")
    found = F.col("_index").isNotNull()
    vector = F.struct(
        F.lit(size).cast("bigint").alias("size"),
        F.when(found, F.array("_index")).otherwise(F.array().cast("array<bigint>")).alias("indices"),
        F.when(found, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
    )
    return joined.withColumn(output, vector).drop("_category", "_index")


def decode_one_hot(df: DataFrame, vector: str, categories: DataFrame, output: str) -> DataFrame:
    """``df`` with the category of the first entry of a vector as ``output``; null for a vector without entries."""
    known = categories.select(F.col("category").alias(output), F.col("index").alias("_index"))
    place = F.get(F.col(f"{vector}.indices"), 0)
    return df.withColumn("_place", place).join(known, F.col("_place") == F.col("_index"), "left").drop("_place", "_index")
