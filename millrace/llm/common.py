"""Shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.workspace import fresh_dir

# The white space that separates words, as a Java pattern: space and the controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stage(frame: DataFrame, label: str, **options) -> DataFrame:
    """Write a frame below the shared folder and read it again.

    This cuts the lineage: what is computed from the result reads files that every executor can
    reach, so a lost executor costs its running tasks only.
    """
    path = fresh_dir(frame.sparkSession, label)
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value evaluated once per row.

    A column that a lambda refers to is evaluated again for every element; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def text_key(text: Column) -> Column:
    """Two independent 64-bit hashes that stand for a whole text in joins."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text, F.lit(2)).alias("b"))


def pieces_of(batches: Iterator[pa.RecordBatch], column: str, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``size`` bytes in a text column, at least a row each."""
    for batch in batches:
        first, held = 0, 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()):
            held += n
            if held >= size:
                yield batch.slice(first, i + 1 - first)
                first, held = i + 1, 0
        if first < batch.num_rows:
            yield batch.slice(first)
