"""Kafka topics, bounded and unbounded.

Reading needs Spark's Kafka connector on the class path. Everything after the read works on any
DataFrame with the connector's row layout, :data:`RECORD_SCHEMA`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the row layout of Spark's Kafka source.
RECORD_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)


def kafka_options(
    servers: str,
    topic: str,
    connection: dict[str, str] | None = None,
    bounded: bool = False,
    starting: str = "earliest",
    ending: str = "latest",
) -> dict[str, str]:
    """Reader options.

    ``connection`` holds client settings such as ``sasl.mechanism`` or ``security.protocol``; each
    is handed to the client under the ``kafka.`` prefix. Only a bounded read has an end offset.
    """
    options = {"kafka.bootstrap.servers": servers}
    for name, value in (connection or {}).items():
        options[name if name.startswith("kafka.") else f"kafka.{name}"] = value
    options["subscribe"] = topic
    options["startingOffsets"] = starting
    if bounded:
        options["endingOffsets"] = ending
    return options


def read_topic(
    spark: SparkSession, servers: str, topic: str, min_partitions: int | None = None, **settings
) -> DataFrame:
    """The records a topic holds now, from the earliest to the latest offset unless told otherwise.

    One task reads one topic partition; ``min_partitions`` splits large ones into offset ranges.
    """
    reader = spark.read.format("kafka").options(**kafka_options(servers, topic, bounded=True, **settings))
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def stream_topic(
    spark: SparkSession, servers: str, topic: str, min_partitions: int | None = None, **settings
) -> DataFrame:
    """An unbounded read of a topic from the earliest offset unless told otherwise."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **settings))
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def decode_json_records(records: DataFrame, schema: str) -> DataFrame:
    """Key as text, the JSON value's fields as columns, and where each record came from."""
    return records.select(
        F.col("key").cast("string").alias("record_key"),
        F.from_json(F.col("value").cast("string"), schema).alias("body"),
        "topic",
        "partition",
        "offset",
    ).select("record_key", "body.*", "topic", "partition", "offset")


def offset_ranges(records: DataFrame) -> DataFrame:
    """First and next offset and record count of each topic partition that was read."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        (F.max("offset") + 1).alias("next_offset"),
        F.count(F.lit(1)).alias("records"),
    )
