"""Random-forest training, holdout score and batch scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.arrays import argmax


def fit_forest(
    train: DataFrame, features: list[str], label: str, trees: int = 20, depth: int = 5, seed: int = 42
) -> PipelineModel:
    """Fit index → forest → decoded label as one model.

    Labels are indexed in alphabetical order, so entry ``i`` of a probability array belongs to the
    i-th label by name.
    """
    indexer = StringIndexer(inputCol=label, outputCol="_target", stringOrderType="alphabetAsc").fit(train)
    stages = [
        VectorAssembler(inputCols=features, outputCol="_features"),
        indexer,
        RandomForestClassifier(
            featuresCol="_features", labelCol="_target", predictionCol="_class", numTrees=trees, maxDepth=depth, seed=seed
        ),
        IndexToString(inputCol="_class", outputCol="predicted", labels=indexer.labels),
    ]
    fitted = Pipeline(stages=stages).fit(train)
    # scoring needs no label column, so the indexer stays out of the stored model
    return PipelineModel([stage for stage in fitted.stages if stage.uid != indexer.uid])


def score_rows(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``prediction`` (probabilities as ``array<float>``), ``prediction_converted`` (class index)
    and ``predicted`` (label)."""
    scored = model.transform(rows).withColumn("prediction", vector_to_array("probability", "float32"))
    scored = scored.withColumn("prediction_converted", argmax(F.col("prediction")))
    return scored.drop("_features", "_class", "rawPrediction", "probability")


def score_struct(model: PipelineModel, rows: DataFrame, packed: str) -> DataFrame:
    """The same for rows whose features are the fields of one struct column, which is kept."""
    fields = rows.schema[packed].dataType.names
    scored = score_rows(model, rows.select("*", *(F.col(f"{packed}.{name}").alias(name) for name in fields)))
    return scored.drop(*fields)


def holdout_score(scored: DataFrame, label: str) -> DataFrame:
    """Share of rows whose predicted label is the true one."""
    hit = (F.col("predicted") == F.col(label)).cast("double")
    return scored.agg(F.avg(hit).alias("score"), F.count(F.lit(1)).alias("rows"))
