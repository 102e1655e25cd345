"""Embeddings, nearest neighbours and arg-max."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.arrays import argmax, argmax_in_pandas
from millrace.operators.vector_index import build_index, index_top_k, probes_for, recall
from millrace.operators.vectors import centroids, cosine_top_k, embed_text, term_counts
from millrace.sources.tables import fixture

NEIGHBOURS = 5
# The share of the exact neighbours that the index has to find, and the share it is tuned for on so many other queries.
RECALL = 0.9
TUNED = 0.98
TUNING_QUERIES = 500
DECIMALS = 6


def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors nearest to the mean vector of each label."""
    vectors = fixture(spark, sf_dir, "embeddings")
    found = cosine_top_k(spark, vectors, centroids(vectors, "label"), NEIGHBOURS, "vec_id", "label")
    return found.select(
        F.col("query_id").cast("bigint").alias("label"),
        F.col("rank").cast("bigint").alias("rank"),
        F.col("neighbour_id").alias("vec_id"),
        F.round("score", DECIMALS).alias("score"),
    )


def text_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashing moves words to positions but loses none: counts add up to the number of words."""
    counted = term_counts(fixture(spark, sf_dir, "documents"), "text")
    total = F.aggregate(vector_to_array("terms"), F.lit(0.0), lambda a, b: a + b)
    return counted.select("doc_id", total.cast("bigint").alias("words"))


def text_embedding_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    embedded = embed_text(fixture(spark, sf_dir, "documents"), "text")
    return embedded.select("doc_id", "embedding")


def text_embedding_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    embedded = embed_text(fixture(spark, sf_dir, "documents"), "text")
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return embedded.select("doc_id", F.size("embedding").alias("dimensions"), F.round(F.sqrt(squares), 4).alias("norm"))


def text_search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents most similar to each benchmark text."""
    documents = embed_text(fixture(spark, sf_dir, "documents"), "text").select("doc_id", "embedding")
    asked = embed_text(fixture(spark, sf_dir, "benchmark"), "text").select("item_id", "embedding")
    found = cosine_top_k(spark, documents, asked, NEIGHBOURS, "doc_id", "item_id")
    return found.select(
        F.col("query_id").alias("item_id"), F.col("neighbour_id").alias("doc_id"), "rank", F.round("score", DECIMALS).alias("score")
    )


def _every_fiftieth(vectors: DataFrame) -> DataFrame:
    return vectors.filter("vec_id % 50 = 0")


def vector_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of every fiftieth vector through the index, with all cells probed: the exact answer."""
    vectors = fixture(spark, sf_dir, "embeddings")
    index = build_index(vectors, "vec_id")
    found = index_top_k(index, _every_fiftieth(vectors), NEIGHBOURS, "vec_id", probes=len(index.centroids))
    return found.select(
        F.col("query_id").alias("vec_id"), F.col("neighbour_id").alias("other_id"), "rank", F.round("score", DECIMALS).alias("score")
    )


def vector_index_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the index finds of the exact neighbours of every fiftieth vector, with as many probes as other vectors needed.

    The supplied vectors have no clusters (the nearest neighbour's similarity is about 0.4), so more than half the cells are probed.
    """
    vectors = fixture(spark, sf_dir, "embeddings")
    index = build_index(vectors, "vec_id")
    asked = _every_fiftieth(vectors)
    others = vectors.filter("vec_id % 50 != 0").orderBy(F.xxhash64("vec_id")).limit(TUNING_QUERIES)
    known = cosine_top_k(spark, vectors, others, NEIGHBOURS, "vec_id", "vec_id")
    probes = probes_for(index, others, known, TUNED, "vec_id")
    found = index_top_k(index, asked, NEIGHBOURS, "vec_id", probes=probes)
    exact = cosine_top_k(spark, vectors, asked, NEIGHBOURS, "vec_id", "vec_id")
    share = F.col("hits") / F.col("expected")
    return recall(found, exact).select("expected", (share >= RECALL).alias("recall_reached"))


def argmax_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "embeddings").select("vec_id", argmax(F.col("embedding")).alias("position"))


def argmax_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "embeddings").select("vec_id", argmax_in_pandas("embedding").alias("position"))


QUERIES = {
    "vector_topk": vector_topk,
    "text_term_counts": text_term_counts,
    "text_embedding_default": text_embedding_default,
    "text_embedding_norms": text_embedding_norms,
    "text_search_topk": text_search_topk,
    "vector_index_search": vector_index_search,
    "vector_index_recall": vector_index_recall,
    "argmax_array": argmax_array,
    "argmax_pandas": argmax_pandas,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _embedding(table: str, key: str) -> str:
    """Hashed word counts of every text, scaled to length 1."""
    return rf"""
        SELECT {key}, list_transform(counts, lambda n: CAST(coalesce(n / nullif(sqrt(list_sum(list_transform(counts, lambda x: x * x))), 0), 0) AS FLOAT))
            AS embedding
        FROM (
            SELECT {key}, list_transform(range(256), lambda i: CAST(len(list_filter(positions, lambda p: p = i)) AS DOUBLE)) AS counts
            FROM (
                SELECT {key}, list_transform(
                    list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x20\x09-\x0D]+'), lambda w: w <> ''),
                    lambda w: CAST('0x' || substr(md5(w), 1, 7) AS BIGINT) % 256) AS positions
                FROM {table}))"""


_ARGMAX = "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INT) AS position FROM embeddings"

ORACLES = {
    "vector_topk": f"""
        WITH positions AS (
            SELECT label, unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE AS value FROM embeddings
        ),
        means AS (SELECT label, pos, avg(value) AS mean FROM positions GROUP BY label, pos),
        queries AS (SELECT label, list(mean ORDER BY pos) AS query FROM means GROUP BY label),
        scores AS (
            SELECT q.label, e.vec_id, round(list_cosine_similarity(q.query, e.embedding::DOUBLE[]), 9) AS score
            FROM embeddings e CROSS JOIN queries q
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM scores
        )
        SELECT CAST(label AS BIGINT) AS label, rank, vec_id, round(score, {DECIMALS}) AS score
        FROM ranked WHERE rank <= {NEIGHBOURS}
    """,
    "vector_index_search": f"""
        WITH scores AS (
            SELECT q.vec_id, e.vec_id AS other_id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 9) AS score
            FROM embeddings e CROSS JOIN (FROM embeddings WHERE vec_id % 50 = 0) q
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, other_id)::INTEGER AS rank FROM scores
        )
        SELECT vec_id, other_id, rank, round(score, {DECIMALS}) AS score FROM ranked WHERE rank <= {NEIGHBOURS}
    """,
    "vector_index_recall": f"""
        SELECT {NEIGHBOURS} * count(*) FILTER (vec_id % 50 = 0) AS expected, true AS recall_reached FROM embeddings
    """,
    "text_embedding_default": _embedding("documents", "doc_id"),
    "text_search_topk": f"""
        WITH d AS ({_embedding("documents", "doc_id")}), b AS ({_embedding("benchmark", "item_id")}),
        scores AS (
            SELECT item_id, doc_id, round(list_cosine_similarity(b.embedding::DOUBLE[], d.embedding::DOUBLE[]), 9) AS score
            FROM d CROSS JOIN b WHERE list_max(d.embedding) > 0 AND list_max(b.embedding) > 0
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores
        )
        SELECT item_id, doc_id, rank, round(score, {DECIMALS}) AS score FROM ranked WHERE rank <= {NEIGHBOURS}
    """,
    # Java's split drops trailing empty pieces
    "text_term_counts": r"""
        SELECT doc_id, CAST(len(regexp_split_to_array(regexp_replace(text, '\s+$', ''), '\s')) AS BIGINT) AS words
        FROM documents
    """,
    "text_embedding_norms": "SELECT doc_id, CAST(256 AS INT) AS dimensions, CAST(1 AS DOUBLE) AS norm FROM documents",
    "argmax_array": _ARGMAX,
    "argmax_pandas": _ARGMAX,
}
