"""Incremental ingest of CSV files whose headers may differ or grow."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.csv import BAD_RECORD, csv_layouts, infer_merged_schema, read_layouts, stream_file_list, with_bad_record
from millrace.streaming.run import drain, each_batch


def _schema_changes(spark: SparkSession, table: str) -> list[tuple[int, T.StructType]]:
    """First batch of each schema the ingest has used, in order. One entry per change of schema."""
    try:
        rows = spark.read.schema("batch bigint, schema string").json(f"{table}/schemas").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []  # nothing has been taken in yet
    return sorted(((r.batch, T.StructType.fromJson(json.loads(r.schema))) for r in rows), key=lambda c: c[0])


def ingest_csv(
    spark: SparkSession,
    folder: str,
    table: str,
    checkpoint: str,
    glob: str = "*.csv",
    files_per_batch: int = 1000,
    multi_line: bool = True,
) -> None:
    """Take in the files that are new since the last run.

    The stream carries file names, not contents; each batch of at most ``files_per_batch`` files is
    grouped by header, read by name and written to ``table/data/batch=<id>``. A new column or a wider
    number type is added to the known schema on the way, without a restart. A column whose numbers were
    taken in stays one of numbers: rows where it holds text keep their line in ``_bad_record``.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        layouts = csv_layouts(batch)
        if not layouts:
            return
        earlier = [schema for first, schema in _schema_changes(session, table) if first < batch_id]
        known = {field.name: field.dataType for field in earlier[-1].fields} if earlier else {}
        schema = infer_merged_schema(session, layouts, earlier[-1] if earlier else None, multi_line)
        schema = T.StructType(
            [
                T.StructField(f.name, known[f.name] if f.dataType == T.StringType() and f.name in known else f.dataType)
                for f in schema.fields
                if f.name != BAD_RECORD
            ]
        )
        schema = with_bad_record(schema)
        read_layouts(session, layouts, schema, multi_line).write.mode("overwrite").parquet(f"{table}/data/batch={batch_id}")
        if not earlier or schema != earlier[-1]:
            change = session.createDataFrame([(batch_id, schema.json())], "batch bigint, schema string")
            change.coalesce(1).write.mode("overwrite").json(f"{table}/schemas/from={batch_id}")

    drain(each_batch(stream_file_list(spark, folder, glob, files_per_batch), checkpoint, load))


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    """All rows taken in so far under the current schema; columns a batch did not have are null.

    Batches between two schema changes are read together, so the plan has one branch per change.
    """
    changes = _schema_changes(spark, table)
    if not changes:
        raise ValueError(f"nothing has been ingested to {table}")
    current = changes[-1][1]
    parts = []
    for position, (first, schema) in enumerate(changes):
        batches = F.col("batch") >= first
        if position + 1 < len(changes):
            batches &= F.col("batch") < changes[position + 1][0]
        with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        rows = spark.read.schema(with_batch).parquet(f"{table}/data").filter(batches)
        parts.append(
            rows.select(
                *(
                    (F.col(f"`{f.name}`") if f.name in schema.names else F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in current.fields
                )
            )
        )
    return reduce(DataFrame.unionByName, parts)
