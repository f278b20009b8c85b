"""Places of rows in a total order without a window over all of them.

Rows are dealt by range, sorted within their partition and stored; a row's place is the number
of rows in earlier partitions plus its position in its own. Rows that agree in every key
are told apart by where they were read, so a group of equal rows may be cut by a partition's
border and is no single task's work. Which of such rows stands first is not defined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgtriage.session import materialize

ROWS_PER_PARTITION = 10_000
_POSITION = (1 << 33) - 1  # low bits of monotonically_increasing_id: the position in the partition


def unused(columns: list[str], stem: str) -> str:
    """``stem``, lengthened until no column has the name."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def ranged(rows: DataFrame, keys: list[Column], at: str, name: str) -> DataFrame:
    """``rows`` stored in the order of ``keys``, with ``at`` = struct(part, position): the range
    partition and the position in it. At most ``spark.sql.shuffle.partitions`` partitions."""
    spark = rows.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(most, -(-rows.count() // ROWS_PER_PARTITION)))
    tie = F.col(at)
    dealt = rows.withColumn(at, F.monotonically_increasing_id()).repartitionByRange(parts, *keys, tie).sortWithinPartitions(*keys, tie)
    number = F.monotonically_increasing_id()
    place = F.struct(F.shiftright(number, 33).alias("part"), number.bitwiseAND(F.lit(_POSITION)).alias("position"))
    return materialize(dealt.withColumn(at, place), name)


def numbered(rows: DataFrame, keys: list[Column], place: str, name: str) -> DataFrame:
    """``rows`` with the column ``place``: 0, 1, ... in the order of ``keys``."""
    at, part, before = (unused([*rows.columns, place], stem) for stem in ("at", "part", "before"))
    stored = ranged(rows, keys, at, name)
    counts = stored.groupBy(F.col(f"{at}.part").alias(part)).agg(F.count("*").alias(before))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    counts = counts.select(part, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    joined = stored.join(F.broadcast(counts), F.col(f"{at}.part") == F.col(part))
    return joined.withColumn(place, F.col(before) + F.col(f"{at}.position")).select(*rows.columns, place)
