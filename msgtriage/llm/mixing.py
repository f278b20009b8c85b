"""Mixing sources to target weights by systematic sampling.

Every source gets a target size; a document's expected number of copies is its
source's target over the source's size. Within a source the documents stand in
order of size, their expected copies are summed up, one random offset per source
(from its name and the seed) is added, and a document is emitted once for each
integer boundary its part of the sum crosses. As neighbours have similar sizes, the
words taken come near the target and no document is emitted more often than its
expected copies rounded up.

Documents above ``large_part`` of their source's target are a stratum of their own,
sampled first; the rest of the source then shares what these leave of the target,
so one very long document does not throw a small source off.

The prefix sum needs a document's place in its stratum only, because all documents
there expect the same number of copies. Places are found in two steps, so a
source with a third of all rows is no single task's work: counts per (source, size,
salt) give offsets, and a window within each such cell gives the rest. A cell holds
about ``cell_rows`` rows; sizes with more are salted by the document's hash.

Defined results: a null text has size 0; the null source is a source of its own, last
in order; a source of size 0 has target 0 and takes nothing; repeated rows are
sampled each on its own; rows that agree in doc_id, source and text hash may swap
places, which no result shows. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgtriage.session import materialize

WEIGHTS = (5, 2, 1)
CELL_ROWS = 20_000
LARGE_PART = 0.02


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, 0 for null."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1)
    blank_head = (F.element_at(parts, 1) == "").cast("long")
    blank_tail = ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("long")
    return F.size(parts) - blank_head - blank_tail


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source of ``(source, size)`` rows: ``source, source_size, target``.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` times all sizes; a target stops at ``most`` times its source's size and
    the rest is shared again. That ends at ``target = min(most * size, level * weight)``;
    the level is read off the sources in the order in which they reach their limits.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(place, F.lit(len(weights))).cast("int") + 1)
    per = per.withColumn("weight", weight.cast("double")).withColumn("limit", most * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = share * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", left / rest)  # if this source and all later ones stay below their limits
    free = F.col("level") * F.col("weight") < F.col("limit")
    level = F.first(F.when(free, F.col("level")), ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(level.isNull(), F.col("limit")).otherwise(F.least(F.col("limit"), level * F.col("weight")))
    return per.select("source", "source_size", target.alias("target"))


def copies(docs: DataFrame, seed: int = 7, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, large_part: float = LARGE_PART, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Per document: ``doc_id, source, text_hash, size, source_size, target, n_copies``.

    ``n_copies`` is the number of integer boundaries between the document's prefix
    sums of expected copies plus the source's offset. Documents above ``large_part``
    of their source's target are sampled first; the others share what these leave.
    """
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("size"))
    rows = materialize(rows, "mix-sizes")
    cells = materialize(rows.groupBy("source", "size").agg(F.count("*").alias("cell")), "mix-cells")
    targets = source_targets(cells.select("source", (F.col("size") * F.col("cell")).alias("size")), weights, share, most)
    targets = materialize(targets, "mix-targets").toDF("s", "source_size", "target")
    of_source = F.col("source").eqNullSafe(F.col("s"))
    offset = F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull(), F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    crossed = lambda rate, upto, n: F.floor(rate * upto + offset) - F.floor(rate * (upto - n) + offset)

    cells = cells.join(targets, of_source).drop("s").withColumn("large", F.col("size") > large_part * F.col("target"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = F.sum("cell").over(Window.partitionBy("source", "large").orderBy("size"))
    first = cells.withColumn("words", F.col("size") * F.col("cell")).withColumn("got", F.when(F.col("large"), F.col("size") * crossed(rate, upto, F.col("cell"))))
    rates = first.groupBy("source").agg(
        F.first("target").alias("target"), F.first(rate).alias("rate"), F.coalesce(F.sum("got"), F.lit(0)).alias("got"),
        F.sum(F.when(~F.col("large"), F.col("words")).otherwise(F.lit(0))).alias("rest"),
    )
    after = F.when(F.col("rest") > 0, F.least(F.lit(most), F.greatest(F.lit(0.0), (F.col("target") - F.col("got")) / F.col("rest")))).otherwise(F.lit(0.0))
    rates = rates.select(F.col("source").alias("s"), F.col("rate").alias("large_rate"), after.alias("rest_rate"))
    cells = cells.join(rates, of_source).drop("s").withColumn("rate", F.least(F.lit(most), F.when(F.col("large"), F.col("large_rate")).otherwise(F.col("rest_rate"))))
    cells = materialize(cells.withColumn("salts", F.ceil(F.col("cell") / cell_rows)), "mix-rates")

    info = cells.select(F.col("source").alias("s"), F.col("size").alias("z"), "source_size", "target", "large", "rate", "salts")
    same_cell = of_source & (F.col("size") == F.col("z"))
    own = rows.join(info, same_cell).drop("s", "z")
    own = own.withColumn("key", F.xxhash64("doc_id", "text_hash", F.lit(seed))).withColumn("salt", F.pmod("key", "salts"))
    counts = own.groupBy("source", "large", "size", "salt").agg(F.count("*").alias("n"))
    order = Window.partitionBy("source", "large").orderBy("size", "salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("salt").alias("t"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    placed = own.withColumn("place", F.row_number().over(Window.partitionBy("source", "size", "salt").orderBy("key", "doc_id", "text_hash")))
    placed = placed.join(before, same_cell & (F.col("salt") == F.col("t")))
    n = crossed(F.col("rate"), F.col("before") + F.col("place"), F.lit(1))
    return placed.select("doc_id", "source", "text_hash", "size", "source_size", "target", n.cast("long").alias("n_copies"))


def mix(docs: DataFrame, seed: int = 7, copy_column: str = "copy", **settings) -> DataFrame:
    """The mixed corpus: each document as often as :func:`copies` says, all columns of
    ``docs`` and the number of the copy (from 1) as ``copy_column``."""
    if copy_column in docs.columns:
        raise ValueError(f"documents have a column {copy_column} already; name another")
    n = copies(docs, seed, **settings)
    n = n.groupBy("doc_id", "source", "text_hash").agg(F.sum("n_copies").alias("of_all"), F.count("*").alias("alike"))
    n = n.select("doc_id", "source", "text_hash", F.struct("of_all", "alike").alias(copy_column))
    own = docs.withColumns({f"__{c}": docs[c] for c in ("doc_id", "source")} | {"__hash": F.xxhash64(docs["text"])})
    n = n.toDF("__d", "__s", "__h", copy_column)
    out = own.join(n, F.col("__doc_id").eqNullSafe(F.col("__d")) & F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__hash") == F.col("__h")))
    # of rows that agree in all three, the first ones carry the copies that do not divide evenly
    nth = F.row_number().over(Window.partitionBy("__doc_id", "__source", "__hash").orderBy("__hash")) - 1
    out = out.withColumn("__nth", nth).withColumn("__n", F.floor((F.col(f"{copy_column}.of_all") + F.col(f"{copy_column}.alike") - 1 - F.col("__nth")) / F.col(f"{copy_column}.alike")))
    out = out.where("__n > 0").withColumn(copy_column, F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))))
    return out.select(*docs.columns, copy_column)
