"""Shards along a Hilbert curve over several metadata columns.

Each dimension's value becomes one of ``2 ** bits`` steps, the steps together are a cell of a
grid, and the cell's number on the Hilbert curve is the order of the rows. Neighbours on the
curve are neighbours in all dimensions, so a run of rows covers a small box, and the smallest and
largest values of a shard (:func:`zones`) rule it out for queries on any of the dimensions.

Kinds of dimension: ``linear`` (equal steps between the smallest and the largest value), ``log``
(equal steps of the logarithm, for sizes), ``category`` (equal steps of the value's rank among the
distinct values, in code point order). All three are exact and do not depend on partitions.

The law of the cut is ``rows``: row ``r`` of ``n`` goes to shard ``floor(r * shards / n)``, so the
counts of shards are at most one apart, whatever the order. A cell, a text or a source with a
third of all rows is cut like any other run (:mod:`msgtriage.llm.order`), so equal texts with
equal metadata are neighbours, but a cut may part them, as this law demands.

Everything is SQL expressions: the curve is a state machine whose table is made by a rule.

Defined results: a null value is step 0 and a null category comes before all others; NaN counts
as null, an infinite value as the nearest end; rows in the same cell stand in order of the
``ties`` columns; rows equal in these too may swap slots, which shows in no column of such
rows. A null text has size 0 + 8 and the CRC of no bytes, 0. An empty table has no shards. Texts of any
length are read whole in the scan. Columns of ``docs`` named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgtriage.llm.order import numbered, unused
from msgtriage.session import materialize

SHARDS = 24
BITS = 6
BROADCAST_ROWS = 100_000  # a dimension's distinct values are broadcast up to this counted number
DIMENSIONS = (("source", "category"), ("lang", "category"), ("size", "log"))


def _turn(x: int, by: int, n: int) -> int:
    """``x`` of ``n`` bits, turned left by ``by``."""
    by %= n
    return (x << by | x >> (n - by)) & ((1 << n) - 1)


def curve_table(n: int) -> list[int]:
    """The state machine of the curve in ``n`` dimensions: entry ``state << n | cell`` is
    ``place << 8 | next state``, cell and place being among the ``2 ** n`` parts of a cube.

    A state ``entry * n + axis`` says at which corner the curve enters the cube and along which
    axis it leaves; places within a cube follow the Gray code.
    """
    if not 2 <= n <= 5:
        raise ValueError("2 to 5 dimensions")
    parts = 1 << n
    gray = [i ^ i >> 1 for i in range(parts)]
    place_of = {g: i for i, g in enumerate(gray)}
    trailing = lambda i: (~i & (i + 1)).bit_length() - 1  # noqa: E731, number of trailing one bits
    table = []
    for state in range(parts * n):
        entry, axis = divmod(state, n)
        for cell in range(parts):
            place = place_of[_turn(cell ^ entry, -(axis + 1), n)]
            corner = 0 if place == 0 else gray[(place - 1) // 2 * 2]
            turn = 0 if place == 0 else trailing(place - 1 + place % 2) % n
            after = (entry ^ _turn(corner, axis + 1, n)) * n + (axis + turn + 1) % n
            table.append(place << 8 | after)
    return table


def curve_index(steps: Sequence[Column], bits: int) -> Column:
    """Place on the Hilbert curve of the cell with these coordinates of ``bits`` bits each."""
    n = len(steps)
    if n * bits > 48:
        raise ValueError("dimensions times bits must be 48 at most")
    table = F.array(*[F.lit(x) for x in curve_table(n)])
    cells = []
    for bit in range(bits - 1, -1, -1):
        one = [F.shiftleft(F.shiftright(s, bit).bitwiseAND(F.lit(1)), j) for j, s in enumerate(steps)]
        cells.append(sum(one[1:], one[0]).cast("long"))

    def step(acc: Column, cell: Column) -> Column:
        found = F.get(table, (F.shiftleft(acc.bitwiseAND(F.lit(255)), n) + cell).cast("int"))
        return F.shiftleft(F.shiftright(acc, 8), n + 8) + found.cast("long")

    return F.shiftright(F.aggregate(F.array(*cells), F.lit(0).cast("long"), step), 8)


def _position(value: Column, low: float | None, high: float | None, bits: int) -> Column:
    """Step of a number between ``low`` and ``high``."""
    if low is None or high is None:
        return F.lit(0)
    x = F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))
    part = (x - F.lit(float(low))) / F.lit((float(high) - float(low)) or 1.0)
    return F.coalesce(F.least(F.floor(part * (1 << bits)), F.lit((1 << bits) - 1)).cast("int"), F.lit(0))


def _logarithm(value: Column) -> Column:
    return F.signum(value) * F.log1p(F.abs(value))


def with_curve(docs: DataFrame, dimensions: Sequence[tuple[str, str]], bits: int, column: str) -> DataFrame:
    """``docs`` with the curve index of its row as ``column``. Its dimensions are read once for the
    ends of all numbers and once per category, so ``docs`` should be stored."""
    out, steps, added = docs, [], []
    numbers = {c: kind for c, kind in dimensions if kind != "category"}
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in numbers}
    value = {c: _logarithm(x) if numbers[c] == "log" else x for c, x in value.items()}
    finite = {c: F.when(F.abs(x) < float("inf"), x) for c, x in value.items()}
    ends = docs.agg(F.lit(1), *[f(x) for x in finite.values() for f in (F.min, F.max)]).first()
    for c, kind in dimensions:
        if kind == "category":
            distinct = materialize(docs.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("rows")), "hilbert-values")
            n = distinct.count()
            step, name = unused([*docs.columns, *added], f"{c}_step"), unused([*docs.columns, *added], f"{c}_value")
            ranks = numbered(distinct, [F.col("value").asc_nulls_first()], "rank", "hilbert-ranks")
            ranks = ranks.select(F.col("value").alias(name), F.expr(f"cast(rank * {1 << bits} div {max(1, n)} as int)").alias(step))
            out = out.join(F.broadcast(ranks) if n <= BROADCAST_ROWS else ranks, F.col(c).eqNullSafe(F.col(name))).drop(name)
            added += [step, name]
            steps.append(F.col(step))
        elif kind in ("linear", "log"):
            k = 1 + 2 * list(numbers).index(c)
            steps.append(_position(value[c], ends[k], ends[k + 1], bits))
        else:
            raise ValueError(f"unknown kind of dimension: {kind}")
    return out.select(*docs.columns, curve_index(steps, bits).alias(column))


def assign(docs: DataFrame, dimensions: Sequence[tuple[str, str]] = DIMENSIONS, ties: Sequence[str] = (), shards: int = SHARDS, bits: int = BITS, names: tuple[str, str, str] = ("curve", "shard", "slot")) -> DataFrame:
    """``docs`` with its place on the curve, its shard and its slot there (from 0), as ``names``.

    The rows are dealt once by range with all their columns and stored in the order of the curve."""
    curve, shard, slot = names
    rows = with_curve(docs.drop(*names), dimensions, bits, curve)
    place = unused(rows.columns, "place")
    placed = numbered(rows, [F.col(curve), *[F.col(c).asc_nulls_first() for c in ties]], place, "hilbert-order")
    n = max(1, placed.count())
    placed = placed.withColumn(shard, F.expr(f"cast(`{place}` * {shards} div {n} as int)"))
    before = F.expr(f"(cast(`{shard}` as bigint) * {n} + {shards - 1}) div {shards}")  # the first row of the shard
    return placed.withColumn(slot, F.col(place) - before).drop(place)


def zones(sharded: DataFrame, columns: Sequence[str], shard: str = "shard") -> DataFrame:
    """Per shard the smallest and largest value of each column, and whether it has nulls."""
    stats = [x for c in columns for x in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.bool_or(F.col(c).isNull()).alias(f"{c}_null"))]
    return sharded.groupBy(shard).agg(F.count("*").alias("rows"), *stats)


def measured(docs: DataFrame, size: str = "size", crc: str = "text_crc32") -> DataFrame:
    """``docs`` with the size of its text (UTF-8 bytes plus 8) and the unsigned CRC-32 of them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({size: F.octet_length(text).cast("long") + 8, crc: F.crc32(text)})
