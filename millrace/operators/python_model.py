"""Any Python model as a column function over a struct of features."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def store_model(spark: SparkSession, model: object, path: str) -> None:
    """Store a model, any object with ``predict_proba(rows)``, in one row below the shared folder."""
    spark.createDataFrame([(bytearray(cloudpickle.dumps(model)),)], "model binary").coalesce(1).write.parquet(path)


def model_function(spark: SparkSession, path: str) -> Callable[[Column], Column]:
    """A function of a struct column that gives the stored model's probabilities as ``array<float>``.

    The model's bytes go to each worker once and are loaded once per task, before its first batch; batches arrive by Arrow. The
    fields of the struct, in their order, are the model's columns. A model must fit a worker.
    """
    shipped = spark.sparkContext.broadcast(bytes(spark.read.parquet(path).first()["model"]))

    @F.pandas_udf("array<float>")
    def predicted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = cloudpickle.loads(shipped.value)
        for rows in batches:
            yield pd.Series(list(np.asarray(model.predict_proba(rows.to_numpy(dtype=np.float64)), dtype=np.float32)))

    return predicted


class Forest:
    """Decision trees as arrays: node ``i`` splits on ``feature[i]`` at ``limit[i]``, or is a leaf with ``shares[i]``."""

    def __init__(self, trees: list[dict[str, np.ndarray]]):
        self.trees = trees

    def predict_proba(self, rows: np.ndarray) -> np.ndarray:
        total = 0.0
        for tree in self.trees:
            at = np.zeros(len(rows), dtype=np.int64)
            while (inner := tree["feature"][at] >= 0).any():
                chosen = rows[np.flatnonzero(inner), tree["feature"][at[inner]]]
                left = chosen <= tree["limit"][at[inner]]
                at[inner] = np.where(left, tree["left"][at[inner]], tree["right"][at[inner]])
            total = total + tree["shares"][at]
        return total / len(self.trees)


def python_forest(spark: SparkSession, model: PipelineModel, path: str) -> Forest:
    """The forest of a fitted pipeline as a model without Spark, from the rows that the model writes of itself at ``path``."""
    forest = next(stage for stage in model.stages if hasattr(stage, "treeWeights"))
    forest.write().save(path)
    trees: dict[int, list] = {}
    for row in spark.read.parquet(f"{path}/data").collect():  # a model's nodes
        # one node per row: beside the number of its tree, or in a struct of that name
        node = row["nodeData"] if "nodeData" in row else row
        trees.setdefault(row["treeID"], []).append(node)
    made = []
    for _, nodes in sorted(trees.items()):
        nodes = sorted(nodes, key=lambda n: n["id"])
        counts = np.array([n["impurityStats"] for n in nodes], dtype=np.float64)
        made.append(
            {
                "feature": np.array([n["split"]["featureIndex"] if n["leftChild"] >= 0 else -1 for n in nodes]),
                "limit": np.array([n["split"]["leftCategoriesOrThreshold"][0] if n["leftChild"] >= 0 else 0.0 for n in nodes]),
                "left": np.array([n["leftChild"] for n in nodes]),
                "right": np.array([n["rightChild"] for n in nodes]),
                "shares": counts / counts.sum(axis=1, keepdims=True),
            }
        )
    return Forest(made)
