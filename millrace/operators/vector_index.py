"""An inverted-file index over vectors: cells around centroids, searched cell by cell."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.vectors import MAX_QUERIES, MAX_VECTORS, block_product, numbered_queries, with_direction
from millrace.workspace import fresh_dir

# Centroids are known to every task, so their number is bounded; a row of 256 dimensions takes 2 KB.
MAX_CELLS = 16_384
# Rows that the centroids are fitted on: a random choice by hash, of this many at most per cell.
FITTED_PER_CELL = 256


@dataclass
class VectorIndex:
    """Unit centroids, and where the vectors lie, written in the order of their cells: ``(cell, id, vector)``."""

    centroids: np.ndarray
    path: str

    def vectors(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def unit(vector: Column) -> Column:
    """The vector scaled to length 1, as doubles."""
    as_double = vector.cast("array<double>")
    length = F.sqrt(F.aggregate(as_double, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(as_double, lambda x: x / length)


def nearest_cells(df: DataFrame, centroids: np.ndarray, count: int) -> DataFrame:
    """``df`` with ``cells``: the ``count`` cells whose centroids are most similar to ``vector``, the nearest first."""
    count = min(count, len(centroids))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.asarray(batch["vector"].flatten()).reshape(batch.num_rows, -1).astype(np.float64)
            scores = -(rows @ centroids.T)
            if count < scores.shape[1]:
                some = np.argpartition(scores, count - 1, axis=1)[:, :count]
            else:
                some = np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
            order = np.lexsort((some, np.take_along_axis(scores, some, axis=1)), axis=1)
            cells = np.take_along_axis(some, order, axis=1).astype(np.int32)
            lists = pa.ListArray.from_arrays(np.arange(0, cells.size + 1, cells.shape[1], dtype=np.int32), pa.array(cells.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "cells"])

    fields = ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
    return df.mapInArrow(placed, f"{fields}, cells array<int>")


def build_index(vectors: DataFrame, vector_id: str, vector: str = "embedding", cells: int | None = None, seed: int = 7) -> VectorIndex:
    """Index every row of ``vectors`` that has a direction.

    The centroids are fitted by k-means on a hashed choice of at most :data:`FITTED_PER_CELL` rows per cell, 4 million in
    all; every row is then put into its nearest cell. By default there are about as many cells as a
    cell has rows. Files are written in the order of the cells, so a search reads the row groups of the cells it
    probes; rows of a very full cell spread over several files.
    """
    spark = vectors.sparkSession
    raw = fresh_dir(spark, "index-vectors")
    with_direction(vectors, vector_id, vector, "id").write.parquet(raw)
    rows = spark.read.parquet(raw)
    count = rows.count()
    cells = min(MAX_CELLS, max(1, cells or round(count**0.5)))
    chosen = rows.select(array_to_vector(unit(F.col("vector"))).alias("features"), F.pmod(F.xxhash64("id"), F.lit(1 << 20)).alias("at"))
    chosen = chosen.filter(F.col("at") < F.lit(min(1 << 20, (1 << 20) * FITTED_PER_CELL * cells // max(1, count))))
    fitted = np.zeros((0, 0))
    if count and cells == 1:  # any direction does for a single cell
        fitted = np.ones((1, rows.select(F.size("vector")).first()[0]))
    elif count:
        model = KMeans(k=cells, seed=seed, distanceMeasure="cosine", initMode="random", maxIter=10).fit(chosen.select("features"))
        fitted = np.array(model.clusterCenters())
    if count:
        fitted /= np.maximum(np.linalg.norm(fitted, axis=1, keepdims=True), 1e-300)
    path = fresh_dir(spark, "vector-index")
    placed = nearest_cells(rows, fitted, 1) if count else rows.withColumn("cells", F.array().cast("array<int>"))
    stored = placed.select(F.get("cells", 0).alias("cell"), "id", "vector", F.xxhash64("id").alias("salt"))
    stored.repartitionByRange("cell", "salt").sortWithinPartitions("cell", "salt").drop("salt").write.parquet(path)
    return VectorIndex(fitted, path)


def index_top_k(
    index: VectorIndex,
    queries: DataFrame,
    k: int,
    query_id: str,
    vector: str = "embedding",
    probes: int = 8,
    max_vectors: int = MAX_VECTORS,
    max_queries: int = MAX_QUERIES,
) -> DataFrame:
    """The ``k`` most similar vectors among the ``probes`` nearest cells of each query: ``query_id``, ``neighbour_id``, ``score``, ``rank``.

    Scores are exact, so with all cells probed the answer is that of an exact search. Queries meet the
    vectors of their cells by cell, as two matrices; cells that nobody asks for are not read where the file's statistics
    tell. Fewer than ``k`` rows come back where the probed cells hold fewer.
    """
    spark = queries.sparkSession
    asked = numbered_queries(queries, query_id, vector).drop("cell")
    if not len(index.centroids):
        asked = asked.withColumn("cells", F.array().cast("array<int>"))
    else:
        asked = nearest_cells(asked, index.centroids, probes)
    path = fresh_dir(spark, "probes")
    asked.select(F.explode("cells").alias("cell"), "number", "query_id", "vector").write.parquet(path)
    probing = spark.read.parquet(path)
    bounds = probing.agg(F.min("cell"), F.max("cell")).first()
    held = index.vectors(spark)
    if bounds[0] is not None:
        held = held.filter(F.col("cell").between(bounds[0], bounds[1]))
    held = held.join(F.broadcast(probing.select("cell").distinct()), "cell", "left_semi")  # MAX_CELLS rows at most
    found = block_product(held, probing, k, max_vectors, max_queries)
    return found.select("query_id", "neighbour_id", "score", "rank")


def probes_for(
    index: VectorIndex, queries: DataFrame, exact: DataFrame, share: float, query_id: str, vector: str = "embedding"
) -> int:
    """The smallest number of probes with which ``share`` of the exact neighbours ``(query_id, neighbour_id)`` of ``queries`` are in reach.

    Every neighbour is in reach from the place on that its cell has among the query's cells; the answer is a
    quantile of these places. Measure on queries other than those the index will serve.
    """
    spark = queries.sparkSession
    asked = with_direction(queries, query_id, vector, "query_id")
    order = nearest_cells(asked, index.centroids, len(index.centroids)).select("query_id", "cells")
    cell_of = index.vectors(spark).select(F.col("id").alias("neighbour_id"), "cell")
    places = exact.join(cell_of, "neighbour_id").join(order, "query_id").select(F.array_position("cells", F.col("cell")).alias("place"))
    counted = places.groupBy("place").count().orderBy("place").collect()  # a row per cell
    wanted, reached = share * sum(r["count"] for r in counted), 0
    for r in counted:
        reached += r["count"]
        if reached >= wanted:
            return int(r["place"])
    return len(index.centroids)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row ``(expected, hits)``: how many of the exact neighbours ``(query_id, neighbour_id)`` were found."""
    hits = exact.join(found.select("query_id", "neighbour_id", F.lit(1).alias("hit")).distinct(), ["query_id", "neighbour_id"], "left")
    return hits.agg(F.count("*").alias("expected"), F.count("hit").alias("hits"))
