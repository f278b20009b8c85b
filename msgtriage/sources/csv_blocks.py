"""Multi-line CSV read by many tasks per file (A1).

A quoted field may hold line breaks, so a task that starts in the middle of a file does not
know whether its first line lies inside a field. The text source cuts files into blocks of lines;
two passes over them settle it:

1. every block is read for both cases at once (first line outside, or inside a field) and tells
   in which case each leaves its last line. A prefix scan over these transitions, one narrow row
   a block, gives the case that holds, and the block in which the open record began;
2. every block joins its lines to records. Records that cross a border are read by a pass over their
   blocks alone: they leave as fragments, keyed by the block they began in, one group a record.

Spark's own CSV expression then parses each record. A quote opens a field only at its start, as in
the one-task reader; within one, quotes are doubled. Lines end in ``\\n`` or ``\\r\\n``; the first
record of each file is its header; empty lines are no records. A file that ends inside a quoted field
gives a last record of what is there. Compressed files are one block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgtriage.session import materialize, reach_workers

#: From inside a quoted field to behind its closing quote.
_REST = re.compile(rb'[^"]*(?:""[^"]*)*"(?!")')
_SCANNED = "file string, block long, end_out int, end_in int, in_opens boolean"
_PIECES = "file string, owner long, block long, head boolean, record binary"


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a line that starts inside (or outside) a quoted field ends inside one."""
    if b'"' not in line:
        return inside
    at = 0
    while True:
        if inside or line.startswith(b'"', at):
            closed = _REST.match(line, at if inside else at + 1)
            if closed is None:
                return True
            at, inside = closed.end(), False
        at = line.find(b",", at) + 1
        if not at:
            return False


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, list[bytes]]]:
    """Lines of a batch by block: (file, block, case at its start, owner of the record open there), lines."""
    n, lines = len(batch), batch.column("line").to_pylist()
    other = np.zeros(max(n - 1, 0), bool)
    for c in ("file", "block"):
        column = batch.column(c)
        other |= pc.not_equal(column.slice(1), column.slice(0, max(n - 1, 0))).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(other) + 1).tolist(), n]
    for lo, hi in zip(cuts, cuts[1:]):
        if lo < hi:
            yield tuple(batch.column(c)[lo].as_py() for c in ("file", "block", "start", "owner")), lines[lo:hi]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("end_out", pa.int32()), ("end_in", pa.int32()), ("in_opens", pa.bool_())])

    def row(key, out, inn, began):
        return pa.RecordBatch.from_pylist([dict(file=key[0], block=key[1], end_out=int(out), end_in=int(inn), in_opens=began and inn)], schema)

    last = None
    for batch in batches:
        for key, lines in _runs(batch):
            if key != last:
                if last is not None:
                    yield row(last, out, inn, began)
                last, out, inn, began = key, False, True, False
            for line in lines:
                began |= not inn  # a record begins here if the block starts inside
                same = out == inn
                out = ends_inside(line, out)
                inn = out if same else ends_inside(line, inn)
    if last is not None:
        yield row(last, out, inn, began)


def _records(batches: Iterator[pa.RecordBatch], header: bool, fragments: bool) -> Iterator[pa.RecordBatch]:
    """Records that begin and end in their block, or else the ``fragments`` of the others,
    with the block their record began in."""
    schema = pa.schema([("file", pa.string()), ("owner", pa.int64()), ("block", pa.int64()), ("head", pa.bool_()), ("record", pa.binary())])
    rows: list[tuple] = []
    block = None  # file and block
    parts: list[bytes] | None = None  # lines of the open record
    owner, first = -1, False

    def leave(closed: bool) -> None:
        nonlocal parts, first
        if (closed and owner == block[1]) != fragments and not (first and closed):
            rows.append((block[0], owner, block[1], first, b"\n".join(parts)))
        if closed:
            first, parts = False, None

    for batch in batches:
        for key, lines in _runs(batch):
            if key[:2] != block:
                if parts is not None:
                    leave(False)
                block, first = key[:2], header and key[1] == 0
                parts, owner = ([], key[3]) if key[2] else (None, -1)
            for line in lines:
                inside = parts is not None
                if inside:
                    parts.append(line)
                elif line in (b"", b"\r"):
                    continue
                else:
                    parts, owner = [line], block[1]
                if not ends_inside(line, inside):
                    leave(True)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows = []
    if parts is not None:
        leave(False)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def block_states(lines: DataFrame) -> DataFrame:
    """``file, block, start`` (1: inside a field) and ``owner`` (the block in which the record that is open there began)."""
    start = lines.withColumns({"start": F.lit(0), "owner": F.lit(None).cast("long")})
    seen = start.mapInArrow(_scan, _SCANNED)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = earlier.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a block ends alike in both cases, or keeps the case, or turns it: the last that ends alike
    # and the number of turns since then give the case
    fixed = F.col("end_out") == F.col("end_in")
    turns = seen.withColumn("turns", F.sum(F.when(~fixed, F.col("end_out")).otherwise(0)).over(upto))
    mark = F.last(F.when(fixed, F.struct(F.col("end_out").alias("case"), F.col("turns").alias("turns"))), ignorenulls=True).over(earlier)
    before = F.coalesce(F.sum(F.when(~fixed, F.col("end_out")).otherwise(0)).over(earlier), F.lit(0))
    cases = turns.select("*", mark.alias("mark"), before.alias("before"))
    case = (F.coalesce(F.col("mark.case"), F.lit(0)) + F.col("before") - F.coalesce(F.col("mark.turns"), F.lit(0))) % 2
    cases = cases.withColumn("start", case.cast("int"))
    opens = F.when(F.when(F.col("start") == 0, F.col("end_out") == 1).otherwise(F.col("in_opens")), F.col("block"))
    return cases.withColumn("opens", opens).select("file", "block", "start", F.last("opens", ignorenulls=True).over(earlier).alias("owner"), "opens")


def records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``record``: the records of a CSV file or folder, as strings without their line end."""
    reach_workers(spark)
    lines = (
        spark.read.option("lineSep", "\n").text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    )
    # one narrow row a block (128 MB of input by default) that starts or ends inside a field: small beside any input
    cut = materialize(block_states(lines).where("start = 1 OR opens IS NOT NULL").drop("opens"), "csv-blocks")

    def pieces(fragments: bool) -> DataFrame:
        placed = lines.join(F.broadcast(cut), ["file", "block"], "inner" if fragments else "left")
        placed = placed.select("file", "block", F.coalesce("start", F.lit(0)).alias("start"), "owner", "line")
        return placed.mapInArrow(partial(_records, header=header, fragments=fragments), _PIECES)

    whole = pieces(False).select(F.col("record").cast("string"))
    # a group is one record's own pieces
    stitched = pieces(True).groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("block", F.col("record").cast("string").alias("text")))).alias("parts"), F.bool_or("head").alias("head")
    )
    joined = stitched.where("NOT head").select(F.array_join(F.col("parts.text"), "\n").alias("record"))
    both = whole.unionAll(joined)
    end = F.length("record") - F.col("record").endswith("\r").cast("int")
    return both.select(F.substring("record", F.lit(1), end).alias("record"))


def read(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str], header: bool = True) -> DataFrame:
    """A CSV file or folder with an explicit schema, many tasks a file."""
    parsed = F.from_csv("record", schema.toDDL(), {**options, "multiLine": "true", "mode": "PERMISSIVE"})
    return records(spark, path, header).select(parsed.alias("r")).select("r.*")
