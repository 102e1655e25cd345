"""Row constraints."""

from __future__ import annotations

from pyspark.sql import Observation

from millrace.operators.quality import Constraint, count_violations, drop_violations, observe_violations
from tests.conftest import rows

CONSTRAINTS = (Constraint("positive", "a > 0"), Constraint("has_b", "b IS NOT NULL"))


def sample(spark):
    return spark.createDataFrame([(1, "x"), (0, "x"), (None, "x"), (2, None), (-1, None)], "a int, b string")


def test_a_row_survives_only_if_all_hold_and_unknown_is_violated(spark):
    assert rows(drop_violations(sample(spark), CONSTRAINTS)) == [(1, "x")]


def test_counts_per_constraint(spark):
    assert rows(count_violations(sample(spark), CONSTRAINTS)) == [("has_b", 2), ("positive", 3)]
    assert rows(count_violations(sample(spark).limit(0), CONSTRAINTS)) == [("has_b", 0), ("positive", 0)]


def test_counts_while_writing(spark, tmp_path):
    observation = Observation()
    observed = observe_violations(sample(spark), CONSTRAINTS, observation)
    drop_violations(observed, CONSTRAINTS).write.parquet(str(tmp_path / "good"))
    assert observation.get == {"positive": 3, "has_b": 2}
    assert spark.read.parquet(str(tmp_path / "good")).count() == 1


def test_counts_in_stream_progress(spark, tmp_path):
    source = str(tmp_path / "in")
    sample(spark).write.parquet(source)
    stream = observe_violations(spark.readStream.schema("a int, b string").parquet(source), CONSTRAINTS, "checks")
    query = (
        drop_violations(stream, CONSTRAINTS)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    counted = [p["observedMetrics"]["checks"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(c["positive"] for c in counted) == 3 and sum(c["has_b"] for c in counted) == 2
