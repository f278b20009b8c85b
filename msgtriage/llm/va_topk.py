"""Exact top-k search by inner product over vector-approximation files.

The vectors, as integers ``floor(scale * x)``, are stored twice in the shared folder: an
*approximation file* of blocks with one byte per component (the cell of 256 equal cells
between the block's smallest and largest value), and an *exact file* of one row a vector.

1. For a block of queries the approximation file alone is scanned. Cells give a lower and an
   upper bound of each score; a vector is kept if its upper bound reaches the k-th best
   lower bound that its task has seen for the query, then that of all tasks.
2. Exact vectors are read in order of their bounds: first each query's ``2 k`` best upper
   bounds, then those whose upper bound still reaches the k-th exact score. After that
   no unread vector can be among the first k, so the result is certain.

Queries are a stated set of rows, taken in blocks of about ``query_rows``; only one block of
them is sent to the tasks at a time, so memory grows with neither table nor query set.

Components are whole numbers held as doubles, so all finite ones take part. Bounds carry a slack
for the rounding of large numbers; exact scores are computed in 64-bit integers where these
must suffice and in unbounded integers elsewhere.

Defined results: vectors that are null, empty or hold a null or a non-finite component take no
part, neither as query nor as candidate, and neither do those that ``scale`` makes infinite. A score
that does not fit a long is the nearest long (such scores are ties). Vectors are scored against those of equal length only; ties go to the smaller ``vec_id`` (null ids last);
repeated rows are candidates of their own, only the query's own row is left out; a query with
fewer candidates than k gets them all, one without any has no row. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgtriage.session import materialize

CELLS = 256
LONGEST = float(1 << 63)
BLOCK_ROWS = 2048
QUERY_ROWS = 1024


def _integers(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, integer matrix) of a batch's valid vectors, by length."""
    lists = batch.column("embedding")
    size = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component becomes NaN
    ends = np.cumsum(size)
    for dim in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == dim)
        v = np.floor(scale * flat[(ends[rows] - dim)[:, None] + np.arange(dim)])
        ok = np.isfinite(v).all(axis=1)
        yield batch.column("vec_id").take(pa.array(rows[ok])).cast(pa.int64()), v[ok]


def _exact_rows(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    part, block = TaskContext.get().partitionId(), 0
    for batch in batches:
        for lo in range(0, len(batch), BLOCK_ROWS):
            for ids, v in _integers(batch.slice(lo, BLOCK_ROWS), scale):
                if not len(v):
                    continue
                n = len(v)
                cols = {"block": np.full(n, (part << 32) + block), "pos": np.arange(n, dtype=np.int32)}
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * v.shape[1]), pa.array(v.ravel()))
                yield pa.record_batch({**{k: pa.array(x) for k, x in cols.items()}, "vec_id": ids, "v": lists})
                block += 1


def _approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the approximation file; a batch's rows may be part of a block."""
    for batch in batches:
        block, pos = batch.column("block").to_numpy(), batch.column("pos").to_numpy()
        flat = batch.column("v").flatten().to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
        ends = np.cumsum(batch.column("v").value_lengths().to_numpy())
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            v = flat[ends[a - 1] if a else 0 : ends[b - 1]].reshape(b - a, -1)
            low = v.min(axis=0)
            width = np.floor((v.max(axis=0) - low) / CELLS) + 1
            cell = np.minimum(np.floor((v - low) / width), CELLS - 1).astype(np.uint8)
            yield pa.record_batch(
                {
                    "block": pa.array([int(block[a])], pa.int64()), "first": pa.array([int(pos[a])], pa.int32()), "dim": pa.array([v.shape[1]], pa.int32()),
                    "low": pa.array([low.tobytes()], pa.binary()), "width": pa.array([width.tobytes()], pa.binary()), "cells": pa.array([cell.tobytes()], pa.binary()),
                }
            )


def _bounds(q: np.ndarray, row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds [query, vector] of the scores of a block."""
    low, width = (np.frombuffer(row[c], float) for c in ("low", "width"))
    cell = np.frombuffer(row["cells"], np.uint8).reshape(-1, row["dim"])
    least = low + cell * width
    base = q @ least.T
    slack = 2.0**-40 * (np.abs(q) @ (np.abs(least).max(axis=0) + width))[:, None]  # rounding, if numbers are huge
    bounds = base + (np.minimum(q, 0) @ (width - 1))[:, None] - slack, base + (np.maximum(q, 0) @ (width - 1))[:, None] + slack
    return np.clip(bounds[0], -LONGEST, LONGEST), np.clip(bounds[1], -LONGEST, LONGEST)


def _scan(batches: Iterator[pa.RecordBatch], shared, k: int) -> Iterator[pa.RecordBatch]:
    queries: dict[int, tuple[np.ndarray, np.ndarray]] = shared.value  # length -> (numbers, vectors)
    best = {d: np.full((len(n), k + 1), -np.inf) for d, (n, _) in queries.items()}  # one more for the own row
    for batch in batches:
        for row in batch.to_pylist():
            if row["dim"] not in queries:
                continue
            number, q = queries[row["dim"]]
            low, high = _bounds(q, row)
            top = np.concatenate([best[row["dim"]], low], axis=1)
            top = np.partition(top, -k - 1, axis=1)[:, -k - 1 :]
            best[row["dim"]] = top
            i, j = np.nonzero(high >= top[:, :1])
            yield pa.record_batch(
                {
                    "q": pa.array(number[i]), "block": pa.array(np.full(len(i), row["block"])), "pos": pa.array((row["first"] + j).astype(np.int32)),
                    "low": pa.array(low[i, j]), "high": pa.array(high[i, j]),
                }
            )


def exact_score(q: np.ndarray, v: np.ndarray) -> int:
    """Inner product of whole numbers held as doubles, cut to the range of a long."""
    if len(q) * np.abs(q).max() * np.abs(v).max() < 2.0**62:
        return int(q.astype(np.int64) @ v.astype(np.int64))
    return max(-(1 << 63), min((1 << 63) - 1, sum(int(x) * int(y) for x, y in zip(q, v))))


def _exact_scores(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    queries = shared.value
    place = {int(n): (d, k) for d, (number, _) in queries.items() for k, n in enumerate(number)}
    for batch in batches:
        vectors = map(np.array, batch.column("v").to_pylist())
        score = [exact_score(queries[d][1][k], v) for (d, k), v in zip(map(place.__getitem__, batch.column("q").to_pylist()), vectors)]
        yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("vec_id"), pa.array(score, pa.int64())], ["q", "vec_id", "score"])


def _first(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best inner products of each row that
    ``is_query`` (a condition on ``vec_id``) selects, against all rows but itself."""
    spark = vectors.sparkSession
    exact = vectors.select("vec_id", "embedding").mapInArrow(partial(_exact_rows, scale=scale), "block long, pos int, vec_id long, v array<double>")
    exact = materialize(exact, "va-exact")
    rough = exact.mapInArrow(_approximate, "block long, first int, dim int, low binary, width binary, cells binary")
    rough = materialize(rough, "va-cells")
    chosen = exact.where(is_query)
    blocks = max(1, math.ceil(chosen.count() / query_rows))
    part = F.pmod(F.xxhash64("block", "pos"), F.lit(blocks))
    best = F.col("score").desc(), F.col("vec_id").asc_nulls_last()
    results = []
    for b in range(blocks):
        own = chosen.where(part == b).orderBy("block", "pos").toArrow()
        if not own.num_rows:
            continue
        names = spark.createDataFrame([(i, r["block"], r["pos"], r["vec_id"]) for i, r in enumerate(own.select(["block", "pos", "vec_id"]).to_pylist())], "q long, own_block long, own_pos int, query_id long")
        names = F.broadcast(names)  # query_rows rows
        by_dim: dict[int, list[tuple[int, list[float]]]] = {}
        for i, v in enumerate(own["v"].to_pylist()):
            by_dim.setdefault(len(v), []).append((i, v))
        shared = spark.sparkContext.broadcast({d: (np.array([i for i, _ in vs]), np.array([v for _, v in vs], float)) for d, vs in by_dim.items()})

        kept = rough.mapInArrow(partial(_scan, shared=shared, k=k), "q long, block long, pos int, low double, high double")
        kept = kept.join(names, "q").where("block != own_block or pos != own_pos").select("q", "block", "pos", "low", "high")
        kept = materialize(kept, "va-kept")
        least = _first(kept, k, F.col("low").desc()).groupBy("q").agg(F.min("low").alias("least"), F.count("*").alias("n"))
        kept = kept.join(least, "q").where((F.col("n") < k) | (F.col("high") >= F.col("least"))).select("q", "block", "pos", "high")
        kept = materialize(kept.withColumn("turn", F.row_number().over(Window.partitionBy("q").orderBy(F.col("high").desc(), "block", "pos"))), "va-order")

        def scores(rows: DataFrame) -> DataFrame:
            return rows.join(exact, ["block", "pos"]).select("q", "vec_id", "v").mapInArrow(partial(_exact_scores, shared=shared), "q long, vec_id long, score long")

        known = materialize(scores(kept.where(F.col("turn") <= 2 * k)), "va-scores")
        bar = _first(known, k, *best).groupBy("q").agg(F.min("score").alias("bar"))
        open_ = kept.where(F.col("turn") > 2 * k).join(bar, "q").where(F.col("high") >= F.col("bar"))
        final = _first(known.union(scores(open_)), k, *best).join(names, "q")
        results.append(materialize(final.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "va-result"))
    out = results[0] if results else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for r in results[1:]:
        out = out.union(r)
    return out
