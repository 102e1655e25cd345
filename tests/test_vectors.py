"""Embeddings and nearest neighbours, against brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.operators import vectors
from millrace.operators.vector_index import build_index, index_top_k, probes_for, recall
from millrace.operators.vectors import centroids, cosine_top_k, embed_text
from tests.conftest import physical_plan, rows


def brute(vectors, queries, k):
    found = []
    for q, a in queries:
        scored = []
        for i, b in vectors:
            if np.linalg.norm(b) > 0:
                norm = np.linalg.norm(a) or 1.0
                scored.append((-round(float(np.dot(a, b) / norm / np.linalg.norm(b)), 9), i))
        found += [(q, i, rank + 1) for rank, (_, i) in enumerate(sorted(scored)[:k])]
    return sorted(found)


def table(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors], "id bigint, v array<float>")


@pytest.mark.parametrize("max_vectors, max_queries", [(65_536, 8_192), (40, 7), (1, 1)])
def test_neighbours_are_exact_with_ties_and_blocks(spark, max_vectors, max_queries):
    random = np.random.default_rng(3)
    vectors = [(i, random.integers(-2, 3, 6).astype(np.float32)) for i in range(300)]
    vectors += [(1000 + i, v) for i, v in vectors[:100]]  # copies tie with their originals
    vectors.append((5000, np.zeros(6, np.float32)))
    queries = [(i, random.integers(-2, 3, 6).astype(np.float32)) for i in range(20)]
    found = cosine_top_k(
        spark, table(spark, vectors).repartition(7), table(spark, queries), 5, "id", "id", "v", max_vectors, max_queries
    )
    pairs = sorted((r.query_id, r.neighbour_id, r["rank"]) for r in found.collect())
    assert pairs == brute(vectors, queries, 5)


def test_fewer_vectors_than_asked_for_and_no_queries(spark):
    vectors = table(spark, [(1, [1, 0]), (2, [0, 1])])
    found = cosine_top_k(spark, vectors, vectors.filter("id = 1"), 5, "id", "id", "v")
    assert sorted((r.neighbour_id, r.score) for r in found.collect()) == [(1, 1.0), (2, 0.0)]
    assert cosine_top_k(spark, vectors, vectors.limit(0), 5, "id", "id", "v").count() == 0


def test_ties_give_k_rows_and_odd_queries_are_answered(spark):
    vectors = table(spark, [(i, [1, 0]) for i in range(50)] + [(90, [0, 0]), (91, [0, 1])])
    queries = table(spark, [(7, [2, 0]), (7, [0, 3]), (7, [2, 0]), (8, [0, 0])])
    for block in (1, 2, 512):
        found = cosine_top_k(spark, vectors, queries, 3, "id", "id", "v", max_vectors=20, max_queries=block)
        expected = sorted([(7, 0, 1.0, 1), (7, 1, 1.0, 2), (7, 2, 1.0, 3)] * 2 + [(7, 91, 1.0, 1), (7, 0, 0.0, 2), (7, 1, 0.0, 3)])
        assert sorted(map(tuple, found.collect())) == expected


def test_centroids(spark):
    frame = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("b", [5.0, 5.0])], "g string, v array<double>")
    assert rows(centroids(frame, "g", "v")) == [("a", [2.0, 4.0]), ("b", [5.0, 5.0])]


def test_default_embedding_counts_hashed_words_of_the_whole_text(spark):
    def position(word):
        return int(hashlib.md5(word.encode()).hexdigest()[:7], 16) % 32

    texts = ["One two  TWO\tthree\n", "", "word " * 30_000 + "end", None, "\u00c9t\u00e9 \u00e9t\u00e9"]
    frame = embed_text(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "t", dimensions=32)
    for row in frame.collect():
        counts = np.zeros(32)
        for word in (texts[row.i] or "").split():
            counts[position(word.encode().lower().decode())] += 1
        expected = counts / (np.linalg.norm(counts) or 1.0)
        assert np.allclose(row.embedding, expected, atol=1e-6)
    assert "Exchange" not in physical_plan(frame) and frame.select(F.size("embedding")).first()[0] == 32


def test_text_search_against_brute_force(spark):
    words = ["red", "green", "blue", "one", "two", "three", "four"]
    random = np.random.default_rng(5)
    texts = [" ".join(random.choice(words, 6)) for _ in range(60)]
    embedded = embed_text(spark.createDataFrame(list(enumerate(texts)), "id bigint, t string"), "t", "v", 64)
    vectors = [(r.id, np.array(r.v, dtype=np.float64)) for r in embedded.collect()]
    found = cosine_top_k(spark, embedded, embedded, 3, "id", "id", "v")
    assert sorted((r.query_id, r.neighbour_id, r["rank"]) for r in found.collect()) == brute(vectors, vectors, 3)


def clustered(spark, count=1200, seed=1):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(20, 16))
    vectors = [(i, (centres[i % 20] + 0.2 * random.normal(size=16)).astype(np.float32)) for i in range(count)]
    # a third of all rows are copies of one vector; one has no direction
    vectors += [(10_000 + i, vectors[0][1]) for i in range(count // 2)] + [(90_000, np.zeros(16, np.float32))]
    return vectors


def test_index_with_all_cells_is_exact_and_with_few_cells_nearly(spark):
    vectors = clustered(spark)
    frame = table(spark, vectors).repartition(5)
    asked = [(i, v) for i, v in vectors if i % 50 == 7]
    index = build_index(frame, "id", "v")
    assert index.vectors(spark).count() == len(vectors) - 1 and 20 <= len(index.centroids) <= round((len(vectors) - 1) ** 0.5)
    exact = brute(vectors, asked, 5)
    for limits in ((65_536, 8_192), (50, 3)):
        found = index_top_k(index, table(spark, asked), 5, "id", "v", len(index.centroids), *limits)
        assert sorted((r.query_id, r.neighbour_id, r["rank"]) for r in found.collect()) == exact
    others = table(spark, [(i, v) for i, v in vectors if i % 50 == 30])
    known = cosine_top_k(spark, frame, others, 5, "id", "id", "v")
    probes = probes_for(index, others, known, 0.95, "id", "v")
    assert probes <= len(index.centroids) // 4
    found = index_top_k(index, table(spark, asked), 5, "id", "v", probes)
    reached = recall(found, cosine_top_k(spark, frame, table(spark, asked), 5, "id", "id", "v")).first()
    assert reached["expected"] == 5 * len(asked) and reached["hits"] >= 0.9 * reached["expected"]


def test_index_of_few_or_no_vectors(spark):
    one = table(spark, [(1, [1, 0]), (2, [0, 0])])
    index = build_index(one, "id", "v")
    assert [(r.query_id, r.neighbour_id, r["rank"]) for r in index_top_k(index, one, 3, "id", "v").collect()] == [(1, 1, 1)]
    empty = build_index(one.limit(0), "id", "v")
    assert index_top_k(empty, one, 3, "id", "v").count() == 0 and index_top_k(index, one.limit(0), 3, "id", "v").count() == 0


def test_queries_do_not_pass_the_driver(spark):
    plan = physical_plan(cosine_top_k(spark, table(spark, [(1, [1, 0])]), table(spark, [(1, [1, 0])]), 3, "id", "id", "v"))
    assert "FlatMapCoGroupsInArrow" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("count", [3, 4, 50, 333])
def test_best_by_blocks_is_best_of_all(monkeypatch, count):
    """The same rows as one product of everything, copies and ties included, with the scores of one block held at a time."""
    monkeypatch.setattr(vectors, "BLOCK", 7)
    random = np.random.default_rng(count)
    held = random.integers(-2, 3, size=(count, 3)).astype(np.float64) + 0.5
    units, _ = vectors._unit_rows(random.normal(size=(20, 3)))
    column = pa.chunked_array([pa.array(held[: count // 2].tolist(), pa.list_(pa.float64())), pa.array(held[count // 2 :].tolist(), pa.list_(pa.float64()))])
    whole = list(zip(*vectors._best(units, vectors._unit_rows(held)[0], 4)))
    largest = []
    real = vectors._best
    monkeypatch.setattr(vectors, "_best", lambda u, r, k: largest.append(len(r)) or real(u, r, k))
    assert sorted(zip(*vectors._best_by_blocks(units, column, 4))) == sorted(whole)
    assert max(largest) <= 7
