"""CSV files with line breaks in quoted cells, read by many tasks per file.

Whether a line break ends a record depends on all quotes before it. So the files are read as lines, in the splits that any text
file has, twice: first every split tells how it would end if it began inside a quoted cell, and if it began outside.
Chaining these two answers over the splits of a file says how each one really begins. Then each split puts its lines
together to records. A record that goes over the end of its split is put together from its pieces, a few per split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.workspace import fresh_dir

# Splits that begin inside a quoted cell are named to every task as long as there are fewer; a row takes about 100 bytes.
NAMED_SPLITS = 200_000
_STEP = re.compile(r'\\.|"', re.DOTALL)
# pieces of a record that goes over the end of a split, in the order they have within one
WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3


def ends_inside(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether a quoted cell is open at the end of a line that begins inside one or not.

    A cell is quoted if a quote is its first sign; a quote elsewhere in it means nothing. Within quotes a backslash keeps
    the next sign from meaning anything. A quote that is followed by something else than a separator makes the
    rest of the cell plain, as Spark's reader has it.
    """
    at, length = 0, len(line)
    while True:
        if not inside:
            # whitespace is part of a cell, so only a quote right at its start opens it
            if line.startswith('"', at):
                inside, at = True, at + 1
                continue
            at = line.find(sep, at) + 1
            if not at:
                return False
            continue
        step = _STEP.search(line, at)
        if step is None:
            return True
        at = step.end()
        if step.group() == '"':
            at = line.find(sep, at) + 1
            if not at:
                return False
            inside = False
        elif at >= length:
            return True


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(value, file, split)`` with the lines of a split in their order."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """A batch cut where the split changes."""
    files, splits = batch["file"].dictionary_encode(), batch["split"].to_numpy()
    places = files.indices.to_numpy()
    first = 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or splits[i] != splits[first] or places[i] != places[first]:
            yield (files.dictionary[places[first]].as_py(), int(splits[first])), batch.slice(first, i - first)
            first = i


def _split_ends(lines: DataFrame, sep: str) -> DataFrame:
    """``(file, split, from_outside, from_inside)``: whether a split ends inside a quoted cell, for either beginning."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends = None, [False, True]

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"file": [key[0]], "split": pa.array([key[1]], pa.int64()), "from_outside": [ends[0]], "from_inside": [ends[1]]}
            )

        for batch in batches:
            for name, part in _runs(batch):
                if name != key:
                    if key:
                        yield row()
                    key, ends = name, [False, True]
                # a line without a quote leaves things as they are
                for line in part["value"].filter(pc.match_substring(part["value"], '"')).to_pylist():
                    same = ends[0] == ends[1]
                    ends[0] = ends_inside(line, ends[0], sep)
                    ends[1] = ends[0] if same else ends_inside(line, ends[1], sep)
        if key:
            yield row()

    return lines.mapInArrow(scanned, "file string, split bigint, from_outside boolean, from_inside boolean")


def _split_starts(ends: DataFrame) -> DataFrame:
    """``(file, split)`` of the splits that begin inside a quoted cell; a file's splits are a row per some 128 MB."""

    def chained(table: pa.Table) -> pa.Table:
        inside, found = False, []
        for row in table.sort_by("split").to_pylist():
            if inside:
                found.append(row["split"])
            inside = row["from_inside"] if inside else row["from_outside"]
        files = [table["file"][0].as_py()] * len(found)
        return pa.table({"file": pa.array(files, pa.string()), "split": pa.array(found, pa.int64())})

    return ends.groupBy("file").applyInArrow(chained, "file string, split bigint")


def _assembled(lines: DataFrame, sep: str) -> DataFrame:
    """``(file, split, part, header, record)``: records and, at the ends of splits, pieces of records; blank lines are left out."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, begun, header = None, False, False, False
        held: list[str] = []
        out: list[tuple] = []

        def close() -> None:
            """The split is over: what is held is not finished."""
            if key and (held or inside):
                out.append((*key, TAIL if begun else MIDDLE, header and begun, "\n".join(held)))
            held.clear()

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * 5
            types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["file", "split", "part", "header", "record"]
            )
            out.clear()
            return made

        for batch in batches:
            for name, part in _runs(batch):
                if name != key:
                    close()
                    # begun: the record that is held begins in this split
                    key, inside, header = name, part["inside"][0].as_py(), name[1] == 0
                    begun = not inside
                for line in part["value"].to_pylist():
                    if not inside and not held:
                        line = line.removeprefix("\ufeff") if header else line
                        if not line.strip(" \t\r"):
                            continue
                        begun = True
                    held.append(line)
                    if inside or '"' in line:
                        inside = ends_inside(line, inside, sep)
                    if not inside:
                        record = "\n".join(held).removesuffix("\r")
                        held.clear()
                        if begun and header:
                            header = False
                        else:
                            out.append((*name, WHOLE if begun else HEAD, False, record))
            yield rows()
        close()
        yield rows()

    schema = "file string, split bigint, part int, header boolean, record string"
    return lines.mapInArrow(joined, schema)


def quoted_records(spark: SparkSession, paths: list[str], sep: str = ",") -> DataFrame:
    """``(file, record)``: the records of CSV files, header lines left out, line breaks in quoted cells kept; written and read back.

    Files are split like any text file. Fields end with ``sep``, quotes are ``"``, the escape sign is a backslash, lines
    end with ``\\n`` or ``\\r\\n``. Blank lines between records are no records.
    """
    starts = fresh_dir(spark, "csv-splits")
    lines = _lines(spark, paths)
    _split_starts(_split_ends(lines, sep)).withColumn("inside", F.lit(True)).write.parquet(starts)
    inside = spark.read.parquet(starts)
    if inside.count() <= NAMED_SPLITS:
        begun = lines.join(F.broadcast(inside), ["file", "split"], "left")
    else:  # a split's lines come together again after the join, in their order
        numbered = lines.withColumn("at", F.monotonically_increasing_id()).join(inside, ["file", "split"], "left")
        begun = numbered.repartition("file", "split").sortWithinPartitions("file", "split", "at")
    path = fresh_dir(spark, "csv-records")
    begun = begun.select("value", "file", "split", F.coalesce("inside", F.lit(False)).alias("inside"))
    _assembled(begun, sep).write.parquet(path)
    stored = spark.read.parquet(path)
    pieces = stored.filter(F.col("part") != WHOLE)
    order = Window.partitionBy("file").orderBy("split", "part")
    pieces = pieces.withColumn("number", F.sum(F.when(F.col("part") == TAIL, 1).otherwise(0)).over(order))
    over = pieces.groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("split", "part", "record"))).alias("pieces"), F.max("header").alias("header")
    )  # the pieces of one record
    over = over.filter("not header").select("file", F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record"))
    return stored.filter(F.col("part") == WHOLE).select("file", "record").unionByName(over)


def inferred_types(spark: SparkSession, records: DataFrame, columns: tuple[str, ...]) -> T.StructType:
    """The types Spark infers for ``columns`` from records; a cell with a line break is text with or without it."""
    path = fresh_dir(spark, "csv-lines")
    records.select(F.translate("record", "\r\n", "  ")).write.text(path)
    found = spark.read.option("inferSchema", True).csv(path).schema.fields
    kinds = [f.dataType for f in found] + [T.StringType()] * (len(columns) - len(found))
    return T.StructType([T.StructField(name, kind) for name, kind in zip(columns, kinds)])


def parsed(records: DataFrame, schema: T.StructType, bad_record: str) -> DataFrame:
    """Records as columns; a cell that does not fit is null and its record is kept in ``bad_record``, a column of ``schema``."""
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv("record", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad_record})
    return records.select(row.alias("row")).select("row.*")
