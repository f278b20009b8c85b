"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

A text becomes the set of its n-grams, hashed to ``2 ** BITS`` indicators: byte
n-grams, word n-grams and n-grams of word shapes (letter case, digits, other marks,
repetition of the word before). Each indicator is scaled by its class log-count ratio, rows
are brought to unit length, and a linear hinge-loss model is fitted by dual coordinate
descent. The final weight of an indicator is a blend of the fitted one and the mean size.

The fit uses about ``max_rows`` labelled rows at most, chosen by a hash of the text; its
statistics are Spark aggregates over those rows. Dual coordinate descent runs
in parallel blocks of rows: in each round every block improves its own dual variables
against the shared weights, weighing its own changes by the number of blocks, and
the changes of all blocks are added.

Defined results: a null or empty text has no indicators and gets the score of the bias;
a missing label teaches nothing; with rows of one class only, or none, every score is 0.5;
repeated rows count as often as they occur. Whole texts are used, whatever their length.
:func:`score` keeps all columns of its input.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgtriage.llm.arrays import SHINGLE_MULT, doc_slices, find_words, mix, separator_words
from msgtriage.session import materialize

BITS = 17
BYTE_GRAMS = (1, 2, 3)
WORD_GRAMS = (1, 2)
SHAPE_GRAMS = (1, 2, 3)
MAX_ROWS = 8000
COST = 1.0
BLEND = 0.25
ROUNDS = 5
PASSES = 4
BLOCKS = 8
SMOOTH = 1.0

_SHAPE = np.zeros(256, np.uint64)  # class of a byte, one bit each
_SHAPE[ord("a") : ord("z") + 1] = 1
_SHAPE[ord("A") : ord("Z") + 1] = 2
_SHAPE[ord("0") : ord("9") + 1] = 4
_SHAPE[128:] = 1
for _c in range(0x21, 0x7F):
    if not chr(_c).isalnum():
        _SHAPE[_c] = 8 << (chr(_c) not in ".,") << (chr(_c) in "|")


def _grams(codes: np.ndarray, width: int, salt: int) -> np.ndarray:
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, salt, np.uint64) * SHINGLE_MULT[-1]
    for k in range(width):
        out += codes[k : k + n] * SHINGLE_MULT[k]
    return mix(out)


def indicators(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct indicators of each text, unsorted, in row order."""
    last = np.zeros(1 << BITS, np.int64)
    shift = np.uint64(64 - BITS)
    table = separator_words()
    for lo, hi, data, starts, ends in doc_slices(column, 1 << 20):
        h, first, end, off = find_words(data, starts, ends, table)
        shape = np.zeros(len(h), np.uint64)
        if len(h):
            cut = np.empty(2 * len(h), np.int64)
            cut[::2], cut[1::2] = first, end
            if cut[-1] == len(data):
                cut = cut[:-1]
            shape = np.bitwise_or.reduceat(_SHAPE[data], cut)[::2]
            shape += np.uint64(64) * _SHAPE[data[first]] + np.uint64(4096) * (end - first > 12).astype(np.uint64)
            shape[1:] += np.uint64(8192) * (h[1:] == h[:-1])
        codes = data.astype(np.uint64)
        families = [(_grams(codes, w, w), starts, ends, w) for w in BYTE_GRAMS]
        families += [(_grams(h, w, 16 + w), off[:-1], off[1:], w) for w in WORD_GRAMS]
        families += [(_grams(shape, w, 32 + w), off[:-1], off[1:], w) for w in SHAPE_GRAMS]
        families = [((g >> shift).astype(np.int64), a.tolist(), b.tolist(), w) for g, a, b, w in families]
        for d in range(hi - lo):
            own = np.concatenate([g[a[d] : max(a[d], b[d] - w + 1)] for g, a, b, w in families])
            order = np.arange(len(own))
            last[own] = order  # keeps one place of each indicator
            yield own[last[own] == order]


class Model:
    """Per indicator the log-count ratio and the weight of the scaled indicator, the bias and
    the slope of the score; ``ratio`` is None when nothing could be learned."""

    def __init__(self, ratio: np.ndarray | None, weight: np.ndarray | None, bias: float, slope: float = 1.0):
        self.ratio, self.weight, self.bias, self.slope = ratio, weight, bias, slope

    def margin(self, x: np.ndarray) -> float:
        r = self.ratio[x]
        size = np.sqrt(r @ r)
        return float((r @ self.weight[x]) / size + self.bias) if size > 0 else self.bias


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = list(indicators(batch.column("text")))
        yield pa.record_batch({"label": batch.column("label").cast(pa.int32()), "x": pa.array([np.sort(u).astype(np.int32) for u in own], pa.list_(pa.int32()))})


def sample(rows: DataFrame, *key: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """About ``max_rows`` of ``rows`` at most, chosen by a hash of the key columns."""
    part = min(1.0, max_rows / max(rows.count(), 1))
    return rows.where(F.pmod(F.xxhash64(*key, F.lit(23)), F.lit(1 << 30)) / float(1 << 30) < part)


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(block, labels, copies, indicators of each row) of packed blocks."""
    for k, block in enumerate(batch.column("block").to_pylist()):
        label, copies, sizes, flat = (batch.column(c)[k].values.to_numpy() for c in ("label", "copies", "sizes", "flat"))
        yield block, label, copies, np.split(flat, np.cumsum(sizes)[:-1])


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows of each class hold each indicator."""
    for batch in batches:
        for _, label, copies, rows in _unpacked(batch):
            total = np.zeros((2, 1 << BITS))
            for y, n, x in zip(label, copies, rows):
                total[y, x] += n
            y, at = np.nonzero(total)
            yield pa.record_batch({"label": pa.array(y, pa.int32()), "at": pa.array(at, pa.int32()), "n": pa.array(total[y, at])})


def _descend(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """One round of each block: passes of dual coordinate descent over its rows.

    ``weight`` is the shared primal vector, the bias its last entry. A block's own change
    counts ``blocks`` times in its gradients, so that the changes of all blocks may be
    added up. Returns the new dual variables and the block's change of the weights."""
    ratio, weight, alphas, cost, blocks = shared.value
    for batch in batches:
        for block, label, copies, rows in _unpacked(batch):
            w, alpha = weight.copy(), alphas.get(block, np.zeros(len(rows))).copy()
            sign = label * 2.0 - 1.0
            limit = cost[label] * copies
            scaled = []
            for x in rows:
                x = np.append(x, len(ratio) - 1)
                v = ratio[x]
                size = np.sqrt((v[:-1] ** 2).sum())
                v[:-1] /= size if size > 0 else 1.0
                scaled.append((x, v, float(v @ v)))
            rng = np.random.RandomState(block)
            for _ in range(PASSES):
                for i in rng.permutation(len(rows)):
                    x, v, q = scaled[i]
                    new = min(max(alpha[i] - (sign[i] * (w[x] @ v) - 1.0) / (q * blocks), 0.0), limit[i])
                    if new != alpha[i]:
                        w[x] += (new - alpha[i]) * sign[i] * blocks * v
                        alpha[i] = new
            change = (w - weight) / blocks
            at = np.flatnonzero(change)
            yield pa.record_batch(
                {"block": pa.array([block], pa.int32()), "alpha": pa.array([alpha], pa.list_(pa.float64())), "at": pa.array([at], pa.list_(pa.int32())), "v": pa.array([change[at]], pa.list_(pa.float64()))}
            )


def fit(rows: DataFrame, max_rows: int = MAX_ROWS, rounds: int = ROUNDS, blocks: int = BLOCKS, blend: float = BLEND) -> Model:
    """Learn from ``(text, label)`` rows with labels 0 and 1, about ``max_rows`` at most
    (see :func:`sample`, which callers may apply to keys before they look up texts)."""
    spark = rows.sparkSession
    rows = sample(rows.select("text", "label").where("label in (0, 1)"), "text", max_rows=max_rows)
    data = rows.mapInArrow(_rows, "label int, x array<int>").withColumn("row", F.xxhash64("x", "label"))
    data = data.groupBy("row").agg(F.first("label").alias("label"), F.first("x").alias("x"), F.count("*").alias("copies"))
    # a block is one stored row, so the rounds read it without a shuffle
    data = data.groupBy(F.pmod(F.xxhash64("row", F.lit(5)), F.lit(blocks)).cast("int").alias("block"))
    data = data.agg(F.array_sort(F.collect_list(F.struct("row", "label", "copies", "x"))).alias("r"))
    data = data.select("block", F.expr("r.label").alias("label"), F.expr("r.copies").alias("copies"), F.expr("transform(r, s -> size(s.x))").alias("sizes"), F.flatten(F.expr("r.x")).alias("flat"))
    data = materialize(data.repartition(blocks, "block"), "nbsvm-blocks")
    totals = {r["label"]: r["n"] for r in data.select(F.explode(F.arrays_zip("label", "copies")).alias("z")).groupBy("z.label").agg(F.sum("z.copies").alias("n")).collect()}
    if len(totals) < 2:
        return Model(None, None, 0.0)
    seen = data.mapInArrow(_class_counts, "label int, at int, n double")
    seen = seen.groupBy("label", "at").agg(F.sum("n").alias("n")).toArrow()  # 2 x 2^BITS rows at most
    counts = np.full((2, 1 << BITS), SMOOTH)
    counts[seen["label"].to_numpy(), seen["at"].to_numpy()] += seen["n"].to_numpy()
    p = counts / counts.sum(axis=1, keepdims=True)
    ratio = np.append(np.log(p[1] / p[0]), 1.0)  # the last one is the bias
    cost = np.array([COST * sum(totals.values()) / (2.0 * totals[y]) for y in (0, 1)])  # both classes weigh the same
    weight, alphas = np.zeros(len(ratio)), {}
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((ratio, weight, alphas, cost, blocks))
        step = data.mapInArrow(partial(_descend, shared=shared), "block int, alpha array<double>, at array<int>, v array<double>")
        weight = weight.copy()
        for r in step.toArrow().to_batches():  # a row per block: duals of max_rows rows, 2^BITS changes a block at most
            for k, block in enumerate(r.column("block").to_pylist()):
                alphas = alphas | {block: r.column("alpha")[k].values.to_numpy()}
                weight[r.column("at")[k].values.to_numpy()] += r.column("v")[k].values.to_numpy()
    w = weight[:-1]
    model = Model(ratio[:-1], blend * w + (1 - blend) * np.abs(w).mean(), float(weight[-1]))
    return _calibrated(data, model)


def _margins(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, label, copies, rows in _unpacked(batch):
            yield pa.record_batch({"label": pa.array(label), "copies": pa.array(copies), "margin": pa.array([shared.value.margin(x) for x in rows], pa.float64())})


def _calibrated(data: DataFrame, model: Model) -> Model:
    """Move the bias to the cut that errs least on the fitted rows, both classes weighing
    the same, in the middle of its gap; set the slope by the classes' distance.
    One number per fitted row reaches the driver, so ``max_rows`` bounds it."""
    shared = data.sparkSession.sparkContext.broadcast(model)
    rows = data.mapInArrow(partial(_margins, shared=shared), "label int, copies long, margin double").toArrow()
    y, m = rows["label"].to_numpy(), rows["margin"].to_numpy()
    n = rows["copies"].to_numpy().astype(float)
    n /= np.where(y == 1, n[y == 1].sum(), n[y == 0].sum())
    order = np.argsort(m, kind="stable")
    y, m, n = y[order], m[order], n[order]
    below = np.concatenate([[0.0], np.cumsum(np.where(y == 1, n, -n))])  # error of a cut before each row, but for a constant
    edge = np.concatenate([m[:1] - 1.0, m, m[-1:] + 1.0])
    width = np.where(edge[1:] > edge[:-1], edge[1:] - edge[:-1], -1.0)
    best = np.flatnonzero((below <= below[width > 0].min() + 1e-12) & (width > 0))
    k = best[width[best].argmax()]
    cut = (edge[k] + edge[k + 1]) / 2.0
    apart = abs(np.average(m[y == 1], weights=n[y == 1]) - np.average(m[y == 0], weights=n[y == 0]))
    return Model(model.ratio, model.weight, model.bias - float(cut), 6.0 / max(apart, 1e-9))


def _score(batches: Iterator[pa.RecordBatch], shared, text: str, name: str) -> Iterator[pa.RecordBatch]:
    model: Model = shared.value
    for batch in batches:
        if model.ratio is None:
            score = np.full(len(batch), 0.5)
        else:
            margin = np.fromiter(map(model.margin, indicators(batch.column(text))), float, len(batch))
            score = 1.0 / (1.0 + np.exp(-np.clip(model.slope * margin, -500, 500)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, name])


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1, above 0.5 where label 1 is likelier."""
    if name in docs.columns:
        raise ValueError(f"documents have a column {name} already; choose another name")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*docs.columns, F.lit(0.5).alias(name)).schema
    return docs.mapInArrow(partial(_score, shared=shared, text=text, name=name), schema)
