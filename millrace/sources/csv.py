"""CSV directories, including ones whose files differ in their header lines.

Spark's CSV reader binds columns by position to one schema for the whole directory. When headers
differ between files (a column added later, columns in another order) that would swap columns
silently. Here files are grouped by header line; each group is read with its own column order, and
the groups are merged by name.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.quoted_csv import inferred_types, parsed, quoted_records

# Fixed value: numeric types from narrow to wide, for merging inferred types.
WIDENING = (T.IntegerType(), T.LongType(), T.DoubleType())
# Digits that the whole-number types hold.
DIGITS = {T.IntegerType(): 10, T.LongType(): 19}
# The line of a row with a cell that does not fit its column's type, or with too many or too few cells.
BAD_RECORD = "_bad_record"
_records: dict[tuple, DataFrame] = {}
LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def read_csv_directory(
    spark: SparkSession,
    folder: str | list[str],
    schema: T.StructType | str | None = None,
    sampling_ratio: float | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Files with one common header line.

    Without ``schema`` the types are inferred, which costs an extra pass over the data; on large
    input give the schema. ``multi_line`` makes each file one task; :func:`read_csv_merging` takes line breaks in
    cells and still splits files.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    if schema is not None:
        return reader.schema(schema).option("enforceSchema", False).csv(folder)
    if sampling_ratio:
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.option("inferSchema", True).csv(folder)


def csv_view(spark: SparkSession, name: str, folder: str, **settings) -> None:
    """Make a directory usable in the FROM clause under ``name``."""
    read_csv_directory(spark, folder, **settings).createOrReplaceTempView(name)


def stream_csv_directory(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    files_per_batch: int,
    multi_line: bool = True,
) -> DataFrame:
    """Files with one common header line, each read once. Wrong headers fail instead of swapping.

    Rows that do not fit keep their line in ``_bad_record``, see :func:`with_bad_record`.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.readStream.schema(with_bad_record(schema)).options(**reading(multi_line))
    return reader.option("maxFilesPerTrigger", files_per_batch).csv(folder)


def with_bad_record(schema: T.StructType) -> T.StructType:
    """The schema with a column for rows that do not fit: cells that cannot be read are null, the line is kept there."""
    return schema if BAD_RECORD in schema.names else T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])


def reading(multi_line: bool) -> dict[str, object]:
    """Reader options: headers must agree, bad rows are kept, and cells may hold line breaks.

    With ``multi_line`` a file is one task; without it, files are split and line breaks in cells make bad rows.
    """
    return {
        "header": True,
        "enforceSchema": False,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD_RECORD,
        "multiLine": multi_line,
    }


# ---------------------------------------------------------------- differing headers


@dataclass(frozen=True)
class Layout:
    """Files that share one header line."""

    columns: tuple[str, ...]
    paths: tuple[str, ...]


def list_files(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """Paths below ``folder``. File contents are not read, as only the path column is asked for."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("path")
    )


def stream_file_list(spark: SparkSession, folder: str, glob: str, files_per_batch: int) -> DataFrame:
    """The same as a stream that reports each file once."""
    return (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )


def _header_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First line of each file that is not blank: reads up to its end, not the file. Empty if there is none."""
    from pyarrow import fs

    def first_line(path: str) -> str:
        uri = quote(path.replace("s3a://", "s3://", 1), safe="/:@")
        system, name = fs.FileSystem.from_uri(uri)
        with system.open_input_stream(name) as stream:
            head = b""
            while b"\n" not in head:
                piece = stream.read(64 * 1024)
                if not piece:
                    break
                # blank lines before the header do not count, for Spark's reader either
                head = (head + piece).removeprefix(b"\xef\xbb\xbf").lstrip(b"\r\n \t") if not head.strip() else head + piece
        return head.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r")

    for batch in batches:
        yield pd.DataFrame({"path": batch["path"], "header": [first_line(path) for path in batch["path"]]})


def csv_layouts(files: DataFrame) -> list[Layout]:
    """Group listed files by header line.

    The lines are read by the executors; the driver receives a path and a header per file, as many as
    Spark's own listing gives it. Files without any text have no rows and are left out. For very many
    files use :func:`millrace.streaming.csv_ingest.ingest_csv`, which goes through them in batches.
    """
    headers = files.mapInPandas(_header_lines, "path string, header string").collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in headers:
        if row.header.strip():
            columns = tuple(name.strip() for name in next(csv.reader([row.header])))
            groups.setdefault(columns, []).append(row.path)
    return [Layout(columns, tuple(sorted(paths))) for columns, paths in sorted(groups.items())]


def wider_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """A type that holds both; text when nothing else does."""
    if left == right:
        return left
    decimals = [t for t in (left, right) if isinstance(t, T.DecimalType)]
    if decimals and T.DoubleType() not in (left, right):
        # whole numbers wider than 64 bits are inferred as decimals
        digits = [t.precision - t.scale if isinstance(t, T.DecimalType) else DIGITS.get(t) for t in (left, right)]
        if None not in digits:
            scale = max(t.scale for t in decimals)
            return T.DecimalType(max(digits) + scale, scale) if max(digits) + scale <= 38 else T.DoubleType()
    if decimals and T.DoubleType() in (left, right):
        return T.DoubleType()
    if left in WIDENING and right in WIDENING:
        return WIDENING[max(WIDENING.index(left), WIDENING.index(right))]
    if {left, right} == {T.DateType(), T.TimestampType()}:
        return T.TimestampType()
    return T.StringType()


def records_of(spark: SparkSession, layout: Layout) -> DataFrame:
    """The records of a layout's files, put together once per session and set of files."""
    key = (spark.sparkContext.applicationId, layout)
    if key not in _records:
        if len(_records) >= 64:  # types are inferred and then the same files are read; older ones are not asked for again
            del _records[next(iter(_records))]
        _records[key] = quoted_records(spark, list(layout.paths))
    return _records[key]


def merge_schemas(*schemas: T.StructType) -> T.StructType:
    """All columns by name in order of first appearance, each with its widest type."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            known = types.get(field.name)
            types[field.name] = field.dataType if known is None else wider_type(known, field.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def _without_empty(frame: DataFrame, columns: set[str]) -> T.StructType:
    """The frame's schema less those of ``columns`` that hold no value, which are inferred as text."""
    texts = [f.name for f in frame.schema.fields if f.name in columns and f.dataType == T.StringType()]
    if not texts:
        return frame.schema
    counts = frame.agg(*(F.count(F.col(f"`{name}`")).alias(str(i)) for i, name in enumerate(texts))).first()
    empty = {name for i, name in enumerate(texts) if counts[i] == 0}
    return T.StructType([f for f in frame.schema.fields if f.name not in empty])


def infer_merged_schema(
    spark: SparkSession, layouts: list[Layout], known: T.StructType | None = None, multi_line: bool = True
) -> T.StructType:
    """Infer each layout's types from its files and merge them by name, after the ``known`` columns.

    A column without any value looks like text. Where that would turn another layout's numbers into
    text, the column's values are counted, and an empty one has no say.
    """
    base = [known] if known else []
    if multi_line:
        read = [records_of(spark, layout) for layout in layouts]
        kinds = [inferred_types(spark, records, layout.columns) for layout, records in zip(layouts, read)]
        frames = [parsed(records, with_bad_record(kind), BAD_RECORD).drop(BAD_RECORD) for records, kind in zip(read, kinds)]
    else:
        frames = [read_csv_directory(spark, list(layout.paths)) for layout in layouts]
    merged = merge_schemas(*base, *(frame.schema for frame in frames))
    seen = [field for schema in (*base, *(f.schema for f in frames)) for field in schema.fields]
    clashing = {
        f.name for f in seen if f.dataType != T.StringType() and merged[f.name].dataType == T.StringType()
    }
    if not clashing:
        return merged
    told = merge_schemas(*base, *(_without_empty(frame, clashing) for frame in frames))
    return T.StructType([told[f.name] if f.name in told.names else f for f in merged.fields])


def read_layouts(spark: SparkSession, layouts: list[Layout], schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Read every layout in its own column order and merge by name; absent columns are null.

    A cell that does not fit its column's type is null, and its row's line is kept in ``_bad_record``.
    """
    types = {field.name: field.dataType for field in schema.fields if field.name != BAD_RECORD}
    parts = []
    for layout in layouts:
        own = with_bad_record(T.StructType([T.StructField(name, types[name]) for name in layout.columns]))
        if multi_line:
            part = parsed(records_of(spark, layout), own, BAD_RECORD)
        else:
            part = spark.read.schema(own).options(**reading(False)).csv(list(layout.paths))
        missing = [F.lit(None).cast(types[name]).alias(name) for name in types if name not in layout.columns]
        parts.append(part.select("*", *missing).select(*(F.col(f"`{name}`") for name in (*types, BAD_RECORD))))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def read_csv_merging(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch read of a directory whose files may have different headers. Bad rows keep their line in ``_bad_record``."""
    layouts = csv_layouts(list_files(spark, folder))
    return read_layouts(spark, layouts, schema or infer_merged_schema(spark, layouts))
