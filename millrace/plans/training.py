"""Feature preparation, a forest and its scores, on the line items."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.features import (
    OneHot,
    Standardiser,
    category_table,
    decode_one_hot,
    read_split,
    sparse_one_hot,
    split_side,
    store_split,
)
from millrace.operators.forest import fit_forest, holdout_score, score_rows, score_struct
from millrace.operators.python_model import model_function, python_forest, store_model
from millrace.plans.common import built_once
from millrace.sources.tables import fixture
from millrace.workspace import fresh_dir

FEATURES = ["f1", "f2", "f3", "f4"]
TARGET = "l_returnflag"
LABELS = ("A", "N", "R")
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# The forest learns a class that depends on two features, so that what it has learnt can be judged.
CLASS = "kind"
# Share of unseen rows that it must get right.
LEAST_SCORE = 0.9
DECIMALS = 4


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "lineitem").select(
        *KEYS,
        F.col("l_quantity").alias("f1"),
        F.col("l_extendedprice").alias("f2"),
        F.col("l_discount").alias("f3"),
        F.col("l_tax").alias("f4"),
        TARGET,
        F.when(F.col("l_quantity") >= 34, "large").when(F.col("l_discount") >= 0.05, "cut").otherwise("plain").alias(CLASS),
    )


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_rows(spark, sf_dir).select(*KEYS, split_side(*KEYS).alias("side"))


def _stored_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    def build(path: str) -> None:
        store_split(feature_rows(spark, sf_dir), path, *KEYS)

    return read_split(spark, built_once(spark, sf_dir, "features", build))


def standardised_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the training rows, applied to all."""
    train, test = _stored_split(spark, sf_dir)
    scaled = Standardiser.fit(train, FEATURES).transform(train.unionByName(test))
    return scaled.select(*KEYS, *(F.round(c, DECIMALS).alias(c) for c in FEATURES))


def one_hot_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feature_rows(spark, sf_dir)
    encoder = OneHot.fit(rows, TARGET)
    encoded = rows.select(*KEYS, encoder.transform(F.col(TARGET)).alias("encoded"))
    return encoded.select(
        *KEYS,
        *(F.col("encoded")[i].alias(f"is_{c}") for i, c in enumerate(LABELS)),
        encoder.inverse(F.col("encoded")).alias("decoded"),
    )


def one_hot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a sparse vector with an entry per part number, and back."""
    rows = feature_rows(spark, sf_dir).select(*KEYS)
    parts = category_table(rows, "l_partkey")
    decoded = decode_one_hot(sparse_one_hot(rows, "l_partkey", parts, "encoded"), "encoded", parts, "decoded")
    return decoded.select(
        *KEYS,
        F.col("encoded.size").alias("size"),
        F.col("encoded.indices")[0].alias("entry"),
        F.col("encoded.values")[0].alias("value"),
        "decoded",
    )


def forest_in_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored forest as a model object of plain Python over a struct column; its probabilities are those of the other path."""
    model, test = _model_and_test_rows(spark, sf_dir)
    path = f"{fresh_dir(spark, 'python-model')}/model"
    store_model(spark, python_forest(spark, model, fresh_dir(spark, "forest")), path)
    packed = score_rows(model, test).withColumn("features", F.struct(*FEATURES))
    scored = packed.withColumn("python", model_function(spark, path)(F.col("features")))
    near = F.forall(F.zip_with("python", "prediction", lambda a, b: F.abs(a - b) < 1e-5), lambda x: x)
    return scored.select(*KEYS, F.size("python").alias("classes"), near.alias("same"))


def feature_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = feature_rows(spark, sf_dir).withColumn("features", F.struct(*FEATURES))
    return packed.select(*KEYS, *(F.col(f"features.{c}").alias(c) for c in FEATURES))


def _model_and_test_rows(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame]:
    """The stored model, trained when first asked for, and the rows it has not seen."""
    train, test = _stored_split(spark, sf_dir)
    test = test.withColumn("clear", (F.abs(F.col("f1") - 34) >= 6) & (F.abs(F.col("f3") - 0.05) >= 0.02))
    scaler = Standardiser.fit(train, FEATURES)

    def build(path: str) -> None:
        fit_forest(scaler.transform(train), FEATURES, CLASS).write().save(path)

    return PipelineModel.load(built_once(spark, sf_dir, "forest", build)), scaler.transform(test)


def _scored_test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_rows(*_model_and_test_rows(spark, sf_dir))


def forest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored from one struct column, as a model function of a struct would be."""
    model, test = _model_and_test_rows(spark, sf_dir)
    packed = test.select(*KEYS, CLASS, "clear", F.struct(*FEATURES).alias("features"))
    scored = score_struct(model, packed, "features")
    # rows near the limits between classes may go either way
    return scored.select(*KEYS, CLASS, F.when(F.col("clear"), F.col("predicted")).alias("predicted"))


def forest_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for every scored row whatever the forest has learnt."""
    scored = _scored_test_rows(spark, sf_dir)
    total = F.aggregate("prediction", F.lit(0.0), lambda a, p: a + p.cast("double"))
    labels = F.array(*(F.lit(c) for c in ("cut", "large", "plain")))
    return scored.select(
        *KEYS,
        F.size("prediction").alias("classes"),
        F.round(total, DECIMALS).alias("total"),
        (F.element_at(labels, F.col("prediction_converted") + 1) == F.col("predicted")).alias("label_is_argmax"),
    )


def forest_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = holdout_score(_scored_test_rows(spark, sf_dir), CLASS)
    return scored.select("rows", (F.col("score") >= LEAST_SCORE).alias("good"))


QUERIES = {
    "split_rows": split_rows,
    "standardised_features": standardised_features,
    "one_hot_target": one_hot_target,
    "one_hot_sparse": one_hot_sparse,
    "forest_in_python": forest_in_python,
    "feature_struct": feature_struct,
    "forest_predictions": forest_predictions,
    "forest_consistency": forest_consistency,
    "forest_score": forest_score,
}

_KEYS = ", ".join(KEYS)
_BUCKET = "CAST('0x' || substr(md5(l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey), 1, 8) AS BIGINT) % 100"
_CLASS = "CASE WHEN l_quantity >= 34 THEN 'large' WHEN l_discount >= 0.05 THEN 'cut' ELSE 'plain' END"
_SOURCES = {"f1": "l_quantity", "f2": "l_extendedprice", "f3": "l_discount", "f4": "l_tax"}

ORACLES = {
    "split_rows": f"SELECT {_KEYS}, CASE WHEN {_BUCKET} < 75 THEN 'train' ELSE 'test' END AS side FROM lineitem",
    "standardised_features": f"""
        WITH s AS (
            SELECT {", ".join(f"avg({c}) AS m_{f}, stddev_pop({c}) AS d_{f}" for f, c in _SOURCES.items())}
            FROM lineitem WHERE {_BUCKET} < 75
        )
        SELECT {_KEYS}, {", ".join(f"round(({c} - m_{f}) / d_{f}, {DECIMALS}) AS {f}" for f, c in _SOURCES.items())}
        FROM lineitem CROSS JOIN s
    """,
    "one_hot_target": f"""
        SELECT {_KEYS}, CAST(l_returnflag = 'A' AS DOUBLE) AS "is_A", CAST(l_returnflag = 'N' AS DOUBLE) AS "is_N",
               CAST(l_returnflag = 'R' AS DOUBLE) AS "is_R", l_returnflag AS decoded
        FROM lineitem
    """,
    "one_hot_sparse": f"""
        WITH parts AS (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS entry FROM (SELECT DISTINCT l_partkey FROM lineitem))
        SELECT {_KEYS}, (SELECT count(*) FROM parts) AS size, entry, CAST(1 AS DOUBLE) AS value, l_partkey AS decoded
        FROM lineitem JOIN parts USING (l_partkey)
    """,
    "forest_in_python": f"SELECT {_KEYS}, CAST(3 AS INT) AS classes, true AS same FROM lineitem WHERE {_BUCKET} >= 75",
    "forest_predictions": f"""
        SELECT {_KEYS}, {_CLASS} AS kind,
               CASE WHEN abs(l_quantity - 34) >= 6 AND abs(l_discount - 0.05) >= 0.02 THEN {_CLASS} END AS predicted
        FROM lineitem WHERE {_BUCKET} >= 75
    """,
    "forest_score": f"SELECT count(*) AS rows, true AS good FROM lineitem WHERE {_BUCKET} >= 75",
    "forest_consistency": f"""
        SELECT {_KEYS}, CAST(3 AS INT) AS classes, CAST(1 AS DOUBLE) AS total, true AS label_is_argmax
        FROM lineitem WHERE {_BUCKET} >= 75
    """,
    "feature_struct": f"SELECT {_KEYS}, {', '.join(f'{c} AS {f}' for f, c in _SOURCES.items())} FROM lineitem",
}
