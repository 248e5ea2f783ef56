"""Reading large CSV files with line breaks inside quoted fields in many tasks.

Spark reads such a file in one task, because a split can't know whether it begins inside a quoted field. Here
the file is read as lines, in splits, twice:

1. Each split reports the state at its end (inside a quoted field or not) for both states it may begin in. A
   split thereby either keeps the state, flips it, or sets it whatever it was; the state at every split's start
   follows from running counts over the splits of a file (one row per split, no text).
2. Each split, its state now known, puts its lines together to records. What is cut by a split's edges, no more
   than two pieces a split, is gathered by the split in which the record begins. The records are stored.

``from_csv``, that is Spark's own CSV parser, then reads the records, the columns that a query needs only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import scratch_path
from . import io

SPLITS = "file long, block long, if_out boolean, if_in boolean, starts_in boolean"
RECORDS = "file long, block long, place long, whole boolean, header boolean, value string"


class Quoting:
    """How a line changes the state: whether a quoted field is open behind it."""

    def __init__(self, quote: str, escape: str | None, sep: str):
        self.quote, self.sep = quote, sep
        doubled = escape == quote
        esc = "\\" if escape is None else escape
        # what can stand inside a quoted field with a quote in it, and the quote that ends it
        pair = re.escape(quote) * 2 if doubled else re.escape(esc) + "[" + re.escape(esc + quote) + "]"
        self.mark = re.compile(f"({pair})|{re.escape(quote)}")

    def _field_end(self, line: str, i: int) -> int:
        """Behind the quote that ends a quoted field which is open at ``i``; -1 if it stays open."""
        while m := self.mark.search(line, i):
            if m[1] is None:
                return m.end()
            i = m.end()
        return -1

    def open_after(self, line: str, inside: bool) -> bool:
        i = 0
        while True:
            if not inside and line.startswith(self.quote, i):
                inside, i = True, i + 1
            if inside:
                i = self._field_end(line, i)
                if i < 0:
                    return True
                inside = False
            # a quote within an unquoted field, or behind a quoted one, is a character like others
            i = line.find(self.sep, i) + 1
            if not i:
                return False


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """The rows of one split after the other, as they come: (file, block, part of its rows)."""
    for b in batches:
        file, block = b["file"].to_numpy(), b["block"].to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1).tolist(), b.num_rows]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            if y > x:
                yield int(file[x]), int(block[x]), b.slice(x, y - x)


def _scan(quoting: Quoting):
    """A row per split: the state at its end after either state at its start, and whether a record begins in it
    if it starts inside a field (otherwise its first line begins one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        for file, block, part in _runs(batches):
            if not out or out[-1][:2] != [file, block]:
                out.append([file, block, False, True, False])
            now = out[-1]
            now[4] |= not now[3]
            marked = np.flatnonzero(pc.match_substring(part["value"], quoting.quote).to_numpy(zero_copy_only=False))
            for at, line in zip(marked.tolist(), part["value"].take(pa.array(marked)).to_pylist(), strict=True):
                now[2], now[3] = quoting.open_after(line, now[2]), quoting.open_after(line, now[3])
                now[4] |= not now[3] and at + 1 < part.num_rows
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(("file", "block", "if_out", "if_in", "starts_in"), map(list, zip(*out, strict=True)), strict=True)))

    return run


def split_states(splits: DataFrame) -> DataFrame:
    """file, block, inside (the state at a split's start), owner (the split in which the record begins that a split
    starts in)."""
    order = Window.partitionBy("file").orderBy("block")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    flips = F.sum((~F.col("if_in") & F.col("if_out")).cast("long")).over(upto)
    sets = F.when(F.col("if_out") == F.col("if_in"), F.struct(F.col("if_out").cast("int").alias("to"), F.col("flips")))
    rows = splits.withColumn("flips", flips).withColumn("anchor", F.last(sets, ignorenulls=True).over(upto))
    after = F.coalesce(F.col("anchor.to"), F.lit(0)) + F.col("flips") - F.coalesce(F.col("anchor.flips"), F.lit(0))
    rows = rows.withColumn("after", F.pmod(after, F.lit(2)) == 1).withColumn("inside", F.coalesce(F.lag("after").over(order), F.lit(False)))
    begins = F.when(~F.col("inside") | F.col("starts_in"), F.col("block"))
    return rows.withColumn("owner", F.coalesce(F.last(begins, ignorenulls=True).over(before), F.lit(0))).select("file", "block", "inside", "owner")


def _assemble(quoting: Quoting, states: dict[tuple[int, int], tuple[bool, int]], header: bool):
    """The records of a split, and what it has of records that begin before or end behind it. ``block`` is the split
    in which the record begins, ``place`` orders its pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, lead, held, first = None, False, False, [], False

        def rows(parts: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(dict(zip(("file", "block", "place", "whole", "header", "value"), map(list, zip(*parts, strict=True)), strict=True)))

        def rest() -> list:
            """The record that the split's end cuts off, or the middle of one."""
            if not held:
                return []
            owner = states[key][1] if lead else key[1]
            return [(key[0], owner, key[1] * 2 + (not lead), False, first and not lead, "\n".join(held))]

        for file, block, part in _runs(batches):
            out = []
            if key != (file, block):
                if key:
                    out += rest()
                key = (file, block)
                if key not in states:
                    raise RuntimeError("the splits of a CSV file changed between two reads of it; read it again")
                inside = lead = states[key][0]
                held, first = [], header and block == 0 and not inside
            has = pc.match_substring(part["value"], quoting.quote).to_pylist()
            for line, marked in zip(part["value"].to_pylist(), has, strict=True):
                held.append(line)
                if marked:
                    inside = quoting.open_after(line, inside)
                if inside:
                    continue
                if lead:
                    out.append((file, states[key][1], block * 2, False, False, "\n".join(held)))
                elif not first:
                    out.append((file, block, block * 2, True, False, "\n".join(held)))
                first = first and lead
                held, lead = [], False
            if out:
                yield rows(out)
        if key and (last := rest()):
            yield rows(last)

    return run


def _own_session(spark: SparkSession, split_bytes: int | None, tasks: int | None) -> SparkSession:
    """A session whose scans are always split alike, whatever executors come and go."""
    pinned = {"spark.sql.files.minPartitionNum": str(tasks or spark.sparkContext.defaultParallelism)}
    if split_bytes:
        pinned["spark.sql.files.maxPartitionBytes"] = str(split_bytes)
    return io.own_session(spark, **pinned)


def csv_records(spark: SparkSession, path: str, *, quote: str = '"', escape: str | None = '"', sep: str = ",",
                header: bool = True, split_bytes: int | None = None, tasks: int | None = None) -> DataFrame:
    """The records of CSV files as stored text rows (``value``), without header records and empty lines."""
    own, quoting = _own_session(spark, split_bytes, tasks), Quoting(quote, escape, sep)
    lines = own.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    splits = split_states(lines.mapInArrow(_scan(quoting), SPLITS))
    # as many rows as the scan has splits, all of which the driver lists to plan it
    known = splits.toArrow()
    states = own.sparkContext.broadcast({(f, b): (i, o) for f, b, i, o in zip(*(known[c].to_pylist() for c in ("file", "block", "inside", "owner")), strict=True)})

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _assemble(quoting, states.value, header)(batches)

    stored = scratch_path(spark, "csv-records")
    lines.mapInArrow(assemble, RECORDS).write.parquet(stored)
    rows = spark.read.parquet(stored)
    pieces = rows.where("not whole").groupBy("file", "block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]), "\n").alias("value"), F.max("header").alias("header"))
    records = rows.where("whole").select("value").unionAll(pieces.where("not header").select("value"))
    # a file whose lines end in carriage return and line feed: both mean a line break inside fields as well
    crlf = F.regexp_replace(F.expr("left(value, length(value) - 1)"), "\r\n", "\n")
    return records.select(F.when(F.col("value").endswith("\r"), crlf).otherwise(F.col("value")).alias("value")).where("value != ''")


def read_csv_split(spark: SparkSession, path: str, schema: StructType | str, *, quote: str = '"', escape: str | None = '"',
                   mode: str = "PERMISSIVE", corrupt_column: str | None = None, split_bytes: int | None = None,
                   tasks: int | None = None) -> DataFrame:
    """The rows that ``read_csv_table(..., multiline=True)`` reads, from as many tasks as the files have splits.

    Lines end in line feeds, with or without carriage returns before them.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"multiLine": "true", "quote": quote, "mode": mode}
    if escape is not None:
        options["escape"] = escape
    if corrupt_column:
        options["columnNameOfCorruptRecord"] = corrupt_column
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType(), True)])
    records = csv_records(spark, path, quote=quote, escape=escape, split_bytes=split_bytes, tasks=tasks)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.select(F.from_csv("value", ddl, options).alias("r")).select("r.*")
