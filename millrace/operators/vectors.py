"""Text embedding and exact nearest neighbours by cosine similarity."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.workspace import fresh_dir

# Similarities are compared at this many decimals, so that copies of a vector tie exactly whatever
# batch they were multiplied in; ties go to the smaller id.
SCORE_DECIMALS = 9
# Vectors and queries that meet in one task, and queries multiplied at once.
MAX_VECTORS = 65_536
MAX_QUERIES = 8_192
SCORED = 256
# Vectors that the queries are multiplied with at once.
BLOCK = 4_096

# (rows, name of the text column) to the rows with an ``embedding`` column
Embedder = Callable[[DataFrame, str], DataFrame]


def term_counts(df: DataFrame, text: str, output: str = "terms", dimensions: int = 256) -> DataFrame:
    """Hashed counts of the lower-case words of ``text``, as a sparse vector."""
    words = Tokenizer(inputCol=text, outputCol="_words").transform(df)
    return HashingTF(inputCol="_words", outputCol=output, numFeatures=dimensions).transform(words).drop("_words")


def hashed_counts(texts: pa.Array, dimensions: int) -> np.ndarray:
    """Per text and position the number of words that hash there: the first 28 bits of the word's MD5, modulo ``dimensions``.

    Words are runs without ASCII white space, with A-Z in lower case; a null or empty text has none.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "").cast(pa.string())))
    coded = split.flatten().dictionary_encode()
    position = np.array(
        [int(hashlib.md5(w.encode(), usedforsecurity=False).hexdigest()[:7], 16) % dimensions if w else -1 for w in coded.dictionary.to_pylist()],
        dtype=np.int64,
    )
    at = position[np.asarray(coded.indices)] if len(coded) else np.zeros(0, dtype=np.int64)
    of = np.repeat(np.arange(len(texts)), np.diff(np.asarray(split.offsets)))
    flat = np.bincount((of * dimensions + at)[at >= 0], minlength=len(texts) * dimensions)
    return flat.reshape(len(texts), dimensions)


def embed_text(df: DataFrame, text: str, output: str = "embedding", dimensions: int = 256) -> DataFrame:
    """Default embedding: hashed word counts scaled to length 1, as ``array<float>``; zeros for a text without words.

    Works batch by batch on whole texts, with no shuffle and no vocabulary to build. Any function of the
    same shape can take its place, such as one that calls a model in a pandas UDF.
    """

    @F.pandas_udf("array<float>")
    def embedded(texts: pd.Series) -> pd.Series:
        rows = []
        for first in range(0, len(texts), 256):
            counts = hashed_counts(pa.array(texts.iloc[first : first + 256], pa.string(), from_pandas=True), dimensions)
            lengths = np.sqrt((counts * counts).sum(axis=1))
            rows += list((counts / np.where(lengths == 0, 1.0, lengths)[:, None]).astype(np.float32))
        return pd.Series(rows)

    return df.withColumn(output, embedded(F.col(text)))


def _unit_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.linalg.norm(matrix, axis=1)
    return matrix / np.where(norms == 0, 1.0, norms)[:, None], norms > 0


def _best(units: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exactly ``k`` rows per query, or all: places of queries and of rows, and scores; of equal scores the first rows."""
    scores = np.round(units @ rows.T, SCORE_DECIMALS)
    if scores.shape[1] > k:
        # what is above the k-th best score, and of the rows at that score the first
        bound = -np.partition(-scores, k - 1, axis=1)[:, k - 1][:, None]
        above, level = scores > bound, scores == bound
        missing = k - above.sum(axis=1, keepdims=True)
        query_at, row_at = np.nonzero(above | (level & (np.cumsum(level, axis=1) <= missing)))
    else:
        query_at, row_at = np.nonzero(np.ones_like(scores, dtype=bool))
    return query_at, row_at, scores[query_at, row_at]


def _best_by_blocks(units: np.ndarray, vectors: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`_best` over all ``vectors``, :data:`BLOCK` of them at a time: only the best so far and one block's scores are held."""
    query_at, row_at, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    for first in range(0, len(vectors), BLOCK):
        rows, _ = _unit_rows(_matrix(vectors.slice(first, BLOCK)))
        more_query, more_row, more_scores = _best(units, rows, k)
        query_at, row_at = np.concatenate([query_at, more_query]), np.concatenate([row_at, more_row + first])
        scores = np.concatenate([scores, more_scores])
        order = np.lexsort((row_at, -scores, query_at))
        query_at, row_at, scores = query_at[order], row_at[order], scores[order]
        # a query's rows lie together, best first
        place = np.arange(len(query_at)) - np.searchsorted(query_at, query_at)
        query_at, row_at, scores = query_at[place < k], row_at[place < k], scores[place < k]
    return query_at, row_at, scores


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    held = column.combine_chunks()
    return np.asarray(held.flatten()).reshape(len(held), -1).astype(np.float64)


def block_product(
    vectors: DataFrame, queries: DataFrame, k: int, max_vectors: int = MAX_VECTORS, max_queries: int = MAX_QUERIES
) -> DataFrame:
    """``(number, query_id, neighbour_id, score, rank)``: the ``k`` best vectors of every query among those of its cells.

    ``vectors (cell, id, vector)`` meet ``queries (cell, number, query_id, vector)`` of the same cell. The vectors of a cell
    are dealt out in parts of about ``max_vectors`` and its queries in chunks of about ``max_queries``; every part meets every
    chunk as two matrices in one task, and ``k`` rows per query leave it. So neither a cell with most vectors
    nor one that most queries ask for is one task's work, and no query passes the driver.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema["id"].dataType.simpleString()
    query_type = queries.schema["query_id"].dataType.simpleString()
    tasks = spark.sparkContext.defaultParallelism
    held = vectors.groupBy("cell").agg(F.count("*").alias("vectors"))
    asked = queries.groupBy("cell").agg(F.count("*").alias("queries"))
    # cells are at most MAX_CELLS rows; small tables still spread over the cores
    part_size = F.least(F.lit(max_vectors), F.greatest(F.lit(1024), F.ceil(F.sum("vectors").over(Window.partitionBy()) / tasks)))
    sizes = held.join(asked, "cell").select(
        "cell",
        F.ceil(F.col("vectors") / part_size).cast("int").alias("parts"),
        F.ceil(F.col("queries") / max_queries).cast("int").alias("chunks"),
    )
    sizes = F.broadcast(sizes)

    def copies(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    key = ["cell", "part", "chunk"]
    dealt = vectors.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    dealt = dealt.select("cell", "part", copies("chunks").alias("chunk"), "id", "vector")
    asking = queries.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("number"), F.col("chunks")).cast("int"))
    asking = asking.select("cell", copies("parts").alias("part"), "chunk", "number", "query_id", "vector")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"number": [], "query_id": [], "neighbour_id": [], "score": []}
        if left.num_rows and right.num_rows:
            left = left.sort_by("id")
            for first in range(0, right.num_rows, SCORED):
                units, _ = _unit_rows(_matrix(right["vector"].slice(first, SCORED)))
                query_at, row_at, scores = _best_by_blocks(units, left["vector"], k)
                out["number"].append(right["number"].take(pa.array(query_at + first)))
                out["query_id"].append(right["query_id"].take(pa.array(query_at + first)))
                out["neighbour_id"].append(left["id"].take(pa.array(row_at)))
                out["score"].append(pa.chunked_array([pa.array(scores)]))
        fields = [right.schema.field("number"), right.schema.field("query_id"), left.schema.field("id"), pa.field("score", pa.float64())]
        columns = [
            pa.chunked_array([c for part in parts for c in part.chunks], type=f.type) for parts, f in zip(out.values(), fields)
        ]
        return pa.table(columns, names=list(out))

    schema = f"number bigint, query_id {query_type}, neighbour_id {id_type}, score double"
    found = dealt.groupBy(*key).cogroup(asking.groupBy(*key)).applyInArrow(best, schema)
    ranks = Window.partitionBy("number").orderBy(F.desc("score"), "neighbour_id")
    return found.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= k)


def with_direction(df: DataFrame, id: str, vector: str, name: str) -> DataFrame:
    """``(name, vector)`` of the rows whose vector is neither null nor of length 0."""
    named = df.select(F.col(id).alias(name), F.col(vector).alias("vector"))
    return named.filter(F.exists("vector", lambda x: x != 0))


def numbered_queries(queries: DataFrame, query_id: str, vector: str) -> DataFrame:
    """``(cell, number, query_id, vector)``: queries with a direction, each row with a number of its own and in cell 0; written and read back."""
    path = fresh_dir(queries.sparkSession, "queries")
    asked = with_direction(queries, query_id, vector, "query_id")
    asked.select(F.lit(0).alias("cell"), F.monotonically_increasing_id().alias("number"), "query_id", "vector").write.parquet(path)
    return queries.sparkSession.read.parquet(path)


def cosine_top_k(
    spark: SparkSession,
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    vector_id: str,
    query_id: str,
    vector: str = "embedding",
    max_vectors: int = MAX_VECTORS,
    max_queries: int = MAX_QUERIES,
) -> DataFrame:
    """The ``k`` vectors most similar to each query: ``query_id``, ``neighbour_id``, ``score``, ``rank``.

    Exact: the :func:`block_product` of all vectors and all queries, as one cell. A query id that comes
    several times is answered as often. Queries and vectors of length 0, or null, have no direction: they get
    no neighbours and are nobody's.
    """
    path = fresh_dir(spark, "vectors")
    # the cell is written, not a literal, so that the planner sees joins by it
    with_direction(vectors, vector_id, vector, "id").withColumn("cell", F.lit(0)).write.parquet(path)
    asked = numbered_queries(queries, query_id, vector)
    found = block_product(spark.read.parquet(path), asked, k, max_vectors, max_queries)
    return found.select("query_id", "neighbour_id", "score", "rank")


def centroids(df: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per group; vectors are summed as vectors before the shuffle."""
    numeric = df.select(group, array_to_vector(F.col(vector).cast("array<double>")).alias("_vector"))
    means = numeric.groupBy(group).agg(Summarizer.mean(F.col("_vector")).alias("_mean"))
    return means.select(group, vector_to_array("_mean").alias(vector))
