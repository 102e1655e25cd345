"""Feature preparation and the forest."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import features
from millrace.operators.features import (
    OneHot,
    Standardiser,
    category_table,
    decode_one_hot,
    sparse_one_hot,
    split_by_key,
    store_split,
)
from millrace.operators.forest import fit_forest, holdout_score, score_rows, score_struct
from millrace.operators.python_model import model_function, python_forest, store_model
from tests.conftest import physical_plan, rows


def test_split_does_not_depend_on_the_partitioning(spark, tmp_path):
    frame = spark.range(4_000).withColumn("line", F.col("id") % 7)
    train, test = split_by_key(frame, "id", "line")
    assert train.count() + test.count() == 4_000 and train.intersect(test).count() == 0
    assert 0.72 < train.count() / 4_000 < 0.78
    again, _ = split_by_key(frame.repartition(3), "id", "line")
    assert rows(again) == rows(train)
    stored = store_split(frame, str(tmp_path / "split"), "id", "line")
    assert [rows(side) for side in stored] == [rows(train), rows(test)]
    assert "PartitionFilters: [isnotnull(side" in physical_plan(stored[0])


def test_standardising_uses_the_population_deviation(spark):
    values = [(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)]
    frame = spark.createDataFrame(values, "a double, b double")
    scaled = Standardiser.fit(frame, ["a", "b"]).transform(frame).collect()
    column = np.array([v[0] for v in values])
    assert np.allclose([r.a for r in scaled], (column - column.mean()) / column.std())
    assert [r.b for r in scaled] == [0.0, 0.0, 0.0]


def test_one_hot_is_sorted_dense_and_reversible(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "t string")
    encoder = OneHot.fit(frame, "t")
    assert encoder.categories == ("a", "b", "c")
    encoded = frame.select("t", encoder.transform(F.col("t")).alias("e"))
    assert {(r.t, tuple(r.e)) for r in encoded.collect()} == {("a", (1, 0, 0)), ("b", (0, 1, 0)), ("c", (0, 0, 1))}
    assert all(r.t == r.d for r in encoded.select("t", encoder.inverse(F.col("e")).alias("d")).collect())
    zeros = spark.createDataFrame([([0.0, 0.0, 0.0],)], "e array<double>")
    assert zeros.select(encoder.inverse(F.col("e"))).first()[0] is None


@pytest.mark.parametrize("value", ["z", None])
def test_one_hot_refuses_what_it_has_not_seen(spark, value):
    encoder = OneHot.fit(spark.createDataFrame([("a",)], "t string"), "t")
    with pytest.raises(Exception, match="unknown category"):
        spark.createDataFrame([(value,)], "t string").select(encoder.transform(F.col("t"))).collect()


def test_one_hot_bounds_its_categories(spark):
    with pytest.raises(ValueError):
        OneHot.fit(spark.range(10), "id", max_categories=9)


def test_forest_learns_scores_and_decodes(spark, tmp_path):
    frame = spark.range(600).select(
        (F.col("id") % 3).alias("c"), (F.col("id") % 3 + F.rand(1) * 0.2).alias("f1"), F.rand(2).alias("f2")
    ).withColumn("label", F.element_at(F.array(F.lit("x"), F.lit("y"), F.lit("z")), (F.col("c") + 1).cast("int")))
    model = fit_forest(frame, ["f1", "f2"], "label", trees=5)
    path = str(tmp_path / "model")
    model.write().save(path)
    scored = score_rows(type(model).load(path), frame.drop("label"))
    row = scored.filter("c = 1").first()
    assert row.prediction_converted == 1 and row.predicted == "y"
    assert len(row.prediction) == 3 and abs(sum(row.prediction) - 1) < 1e-5
    assert dict(scored.dtypes)["prediction"] == "array<float>"
    packed = frame.select("c", F.struct("f1", "f2").alias("features"))
    from_struct = score_struct(model, packed, "features")
    assert from_struct.columns == ["c", "features", "predicted", "prediction", "prediction_converted"]
    assert rows(from_struct.select("features.f1", "predicted")) == rows(score_rows(model, frame).select("f1", "predicted"))
    assert holdout_score(score_rows(model, frame), "label").first().score > 0.95


def test_sparse_one_hot_takes_any_number_of_categories(spark):
    frame = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 != 1, F.concat(F.lit("c"), "id")).alias("t"))
    known = category_table(frame, "t")
    expected = sorted({r.t for r in frame.collect()} - {None})
    assert [(r.category, r["index"]) for r in known.orderBy("index").collect()] == [(c, i) for i, c in enumerate(expected)]
    encoded = decode_one_hot(sparse_one_hot(frame, "t", known, "v"), "v", known, "back")
    for r in encoded.filter("id < 2000").collect():
        assert r.back == r.t and r.v.size == len(expected)
        assert (r.v.indices, r.v["values"]) == (([expected.index(r.t)], [1.0]) if r.t else ([], []))
    unseen = sparse_one_hot(spark.createDataFrame([("z",), (None,)], "t string"), "t", known, "v")
    assert [r.v.indices for r in unseen.collect()] == [[], []]


def test_any_python_model_scores_a_struct(spark, tmp_path):
    class Shares:
        def predict_proba(self, rows):
            return rows / rows.sum(axis=1, keepdims=True)

    store_model(spark, Shares(), str(tmp_path / "model"))
    score = model_function(spark, str(tmp_path / "model"))
    frame = spark.range(1, 9).select("id", F.struct(F.col("id").alias("a"), (F.col("id") * 3).cast("double").alias("b")).alias("f"))
    assert [r.p for r in frame.select(score(F.col("f")).alias("p")).collect()] == [[0.25, 0.75]] * 8


def test_a_forest_outside_spark_gives_the_same_probabilities(spark, tmp_path):
    frame = spark.range(500).select((F.col("id") % 7 * F.rand(1)).alias("f1"), F.rand(2).alias("f2"), F.when(F.col("id") % 7 > 3, "x").otherwise("y").alias("label"))
    model = fit_forest(frame, ["f1", "f2"], "label", trees=4)
    forest = python_forest(spark, model, str(tmp_path / "forest"))
    found = score_rows(model, frame).collect()
    wanted = forest.predict_proba(np.array([[r.f1, r.f2] for r in found]))
    assert np.allclose([r.prediction for r in found], wanted, atol=1e-6)


def test_a_task_reads_a_bounded_part_of_a_stored_split(spark, tmp_path, monkeypatch):
    """One large file of a side is read by several tasks, each with whole row groups of its own."""
    monkeypatch.setattr(features, "TASK_BYTES", 256 << 10)
    frame = spark.range(0, 200_000, 1, 1).select("id", F.rand(1).alias("v"))
    train, test = store_split(frame, str(tmp_path / "split"), "id")
    sizes = [r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 3 and max(sizes) < 60_000
    assert sum(sizes) + test.count() == 200_000
