"""Word and sentence vectors.

Word vectors are a relational table ``(word, vector array<double>)``. Joins
with exploded tokens use a broadcast only under a measured size bound.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgtriage.functions import vectors as V
from msgtriage.operators.features import explode_tokens
from msgtriage.operators.lexicon import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, measured_size, should_broadcast, sized_side


def lookup_vectors(
    df: DataFrame, vectors: DataFrame, key: str = "id", tokens: str = "tokens",
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``(key, pos, word, vector)`` for every in-vocabulary token."""
    long = explode_tokens(df, key, tokens, "word", pos="pos")
    return long.join(sized_side(vectors.select("word", "vector"), broadcast_rows), "word", "inner")


def _vector_sum(col: str, dim: int, weight: Column | None = None) -> list[Column]:
    """Component-wise (optionally weighted) sum of an ``array<double>`` column
    as ``dim`` plain aggregates: codegen'd, partial aggregation, fixed-width
    buffers (no per-element lambda)."""
    w = weight if weight is not None else F.lit(1.0)
    return [F.sum(F.col(col)[i] * w).alias(f"_c{i}") for i in range(dim)]


def _pack(dim: int, out: str) -> Column:
    return F.array(*[F.coalesce(F.col(f"_c{i}"), F.lit(0.0)) for i in range(dim)]).alias(out)


def _numbered(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``words(word, ref)`` and ``stored(ref, vector)``: every distinct vector once, under a
    number, so that joins with tokens move numbers only."""
    from msgtriage.session import materialize

    known = vectors.select("word", "vector", F.coalesce(F.sha2(F.col("vector").cast("string"), 256), F.lit("")).alias("_v"))
    stored = known.groupBy("_v").agg(F.first("vector").alias("vector")).withColumn("ref", F.monotonically_increasing_id())
    stored = materialize(stored, "distinct-vectors")
    words = known.select("word", "_v").join(sized_side(stored.select("_v", "ref")), "_v").select("word", "ref")
    return materialize(words, "vector-words"), stored.select("ref", "vector")


def _block_sums(hits: DataFrame, stored: DataFrame, dim: int, key: str, block_bytes: int) -> DataFrame:
    """``(key, _c0.., _w)``: sums of ``w`` times the vector of ``ref`` over the rows ``(key, ref, w)``
    of ``hits``, which lie partitioned by ``key``, and of ``w``.

    Vectors come to the rows as broadcasts of at most about ``block_bytes``, one after another, and each
    block's sums are complete per document before they move."""
    from msgtriage.session import materialize

    sums = [*_vector_sum("vector", dim, F.col("w")), F.sum("w").alias("_w")]
    blocks = max(1, math.ceil(measured_size(stored)[1] / block_bytes))
    if blocks == 1:
        return hits.join(F.broadcast(stored), "ref").groupBy(key).agg(*sums)
    hits, parts = materialize(hits, "vector-hits"), None
    for b in range(blocks):
        block = F.pmod(F.xxhash64("ref"), F.lit(blocks)) == b
        part = hits.where(block).join(F.broadcast(stored.where(block)), "ref").groupBy(key).agg(*sums)
        part = materialize(part, "vector-sums")
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy(key).agg(*[F.sum(c).alias(c) for c in parts.columns if c != key])


def sentence_vectors(
    df: DataFrame, vectors: DataFrame, dim: int, key: str = "id", tokens: str = "tokens",
    out: str = "sentvec", broadcast_rows: int = DEFAULT_BROADCAST_ROWS, block_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """The reference's recurrence ``v <- (w + v) / dim`` over the in-vocabulary
    tokens of a document, starting from zeros.

    Closed form: ``v = sum_k w_k * dim ** -(m - k + 1)``. Plan: keep only the
    in-vocabulary tokens as narrow ``(key, pos, word)`` rows, rank them from the end
    within each document (a shuffle on ``key``, without vectors), attach the vectors
    after the window, and sum per document in place (the data is already partitioned
    on ``key``). A vocabulary beyond the broadcast bounds is joined as numbers of its
    distinct vectors (``_numbered``), and the vectors are attached in blocks. Every
    token of the whole text takes part (early tokens' weights underflow to 0
    exactly as in the recurrence). Documents without in-vocabulary tokens get
    the zero vector.
    """
    long = explode_tokens(df, key, tokens, "word", pos="pos")
    from_end = Window.partitionBy(key).orderBy(F.desc("pos"))
    weight = F.pow(F.lit(float(dim)), -F.col("_r").cast("double"))
    if should_broadcast(vectors.select("word", "vector"), broadcast_rows, block_bytes):
        known = long.join(F.broadcast(vectors.select("word")), "word", "left_semi")
        ranked = known.withColumn("_r", F.row_number().over(from_end))
        joined = ranked.join(F.broadcast(vectors.select("word", "vector")), "word")
        sums = joined.groupBy(key).agg(*_vector_sum("vector", dim, weight))
    else:
        words, stored = _numbered(vectors)
        words = words.groupBy("word").agg(F.collect_list("ref").alias("_refs"))  # a word listed twice counts twice at one rank
        known = long.join(sized_side(words, broadcast_rows), "word").select(key, "pos", "_refs")
        ranked = known.withColumn("_r", F.row_number().over(from_end))
        hits = ranked.select(key, weight.alias("w"), F.explode_outer("_refs").alias("ref"))
        sums = _block_sums(hits.groupBy(key, "ref").agg(F.sum("w").alias("w")), stored, dim, key, block_bytes).drop("_w")
    return df.select(key).join(sums, key, "left").select(key, _pack(dim, out))


def mean_vectors(
    df: DataFrame, vectors: DataFrame, dim: int, key: str = "id", tokens: str = "tokens",
    out: str = "meanvec", broadcast_rows: int = DEFAULT_BROADCAST_ROWS, block_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Mean of the in-vocabulary word vectors (NaN components when there is none).

    A vocabulary beyond the broadcast bounds is joined as numbers of its distinct vectors, counted per
    document, and the vectors are attached in blocks."""
    long = explode_tokens(df, key, tokens, "word")
    if should_broadcast(vectors.select("word", "vector"), broadcast_rows, block_bytes):
        hits = long.join(F.broadcast(vectors.select("word", "vector")), "word")
        sums = hits.groupBy(key).agg(*_vector_sum("vector", dim), F.count(F.lit(1)).alias("_n"))
    else:
        words, stored = _numbered(vectors)
        hits = long.join(sized_side(words, broadcast_rows), "word").select(key, "ref").repartition(key)
        hits = hits.groupBy(key, "ref").agg(F.count(F.lit(1)).cast("double").alias("w"))
        sums = _block_sums(hits, stored, dim, key, block_bytes).withColumnRenamed("_w", "_n")
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("double")
    return df.select(key).join(sums, key, "left").select(
        key,
        F.array(
            *[
                F.when(n > 0, F.col(f"_c{i}") / n).otherwise(F.lit(float("nan")))
                for i in range(dim)
            ]
        ).alias(out),
    )


# --------------------------------------------------------------------------
# F13 global median fill
# --------------------------------------------------------------------------


def global_median(
    values: DataFrame, col: str = "x", accuracy: int = 10_000, collect_limit: int = 100_000
) -> float | None:
    """Exact median (mean of the two middle values) of non-NaN, non-NULL ``col``.

    Distributed selection: ``percentile_approx`` brackets the middle ranks
    (its rank error is at most m / accuracy), rows outside the bracket are
    counted, not moved, and the bracket is narrowed until it holds at most
    ``collect_limit`` values; only those reach the driver.
    """
    x = F.col(col)
    data = values.select(x.cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    n = data.count()
    if n == 0:
        return None
    k1, k2 = (n - 1) // 2, n // 2
    sub, m, below = data, n, 0
    d = 2.0 / accuracy
    while True:
        r1, r2 = k1 - below, k2 - below
        if m <= collect_limit:
            vals = sorted(r["x"] for r in sub.collect())
            return (vals[r1] + vals[r2]) / 2.0
        f1, f2 = max(r1 / m - d, 0.0), min(r2 / m + d, 1.0)
        a, b = sub.agg(F.percentile_approx("x", [f1, f2], accuracy).alias("q")).first()["q"]
        v = F.col("x")
        c = sub.agg(
            F.count_if(v < a).alias("less"), F.count_if(v == a).alias("at_a"),
            F.count_if((v > a) & (v < b)).alias("mid"), F.max(F.when(v < b, v)).alias("before_b"),
            F.min(F.when(v > a, v)).alias("after_a"),
        ).first()
        to_mid = c["less"] + c["at_a"]  # ranks from here on are above a
        to_b = to_mid + c["mid"]
        if r1 < c["less"] or (a < b and r2 > m - 1):
            d *= 2.0  # the approximate quantile lies above the rank it stands for
            continue
        if r2 < to_mid:
            return float(a)
        if r1 < to_mid:
            return (float(a) + float(c["after_a"])) / 2.0
        if a == b or (r1 >= to_b and r1 >= m):
            d *= 2.0
            continue
        if r1 >= to_b:  # at b, or above it if the quantile was too low
            at_b = sub.where(v == b).count()
            if r2 < to_b + at_b:
                return float(b)
            d *= 2.0
            continue
        if r2 >= to_b:
            return (float(c["before_b"]) + float(b)) / 2.0
        # both ranks lie strictly between: the ends go, so every round shrinks the range
        sub, m, below = sub.where((v > a) & (v < b)), c["mid"], below + to_mid


def fill_nan_global_median(
    df: DataFrame, vec: str, exact: bool = True, accuracy: int = 10_000
) -> tuple[DataFrame, float | None]:
    """replace NaN components of ``vec`` with the median over all
    non-NaN components of the whole column."""
    from msgtriage.session import materialize

    # the selection makes several passes and the fill another: all read the written vectors
    df = materialize(df, "median-input")
    comps = df.select(F.explode_outer(vec).alias("x"))
    if exact:
        med = global_median(comps, "x", accuracy)
    else:
        row = comps.where(~F.isnan("x")).agg(F.percentile_approx("x", 0.5, accuracy)).first()
        med = row[0]
    fill = F.lit(med if med is not None else float("nan")).cast("double")
    return df.withColumn(vec, F.transform(vec, lambda v: F.when(F.isnan(v), fill).otherwise(v))), med


# --------------------------------------------------------------------------
# G3 most similar words
# --------------------------------------------------------------------------


def most_similar(
    vectors: DataFrame,
    positive: Sequence[str],
    negative: Sequence[str] = (),
    topn: int = 10,
) -> DataFrame:
    """``(word, score)`` top-n by cosine to the mean of the unit input vectors
    (positive +1, negative -1), input words excluded, ties by word.

    The query vector (one row, ``dim`` numbers) is computed by an aggregate and
    inlined as a literal; scoring is a projection over the vocabulary and the
    top-n a distributed take-ordered.
    """
    pos, neg = list(positive), list(negative)
    inputs = pos + neg
    signed = vectors.where(F.col("word").isin(*inputs)).select(
        F.when(F.col("word").isin(*pos), F.lit(1.0)).otherwise(F.lit(-1.0)).alias("s"),
        V.unit("vector").alias("u"),
    )
    rows = signed.collect()  # at most len(inputs) rows
    if not rows:
        raise KeyError(f"none of {inputs} is in the vocabulary")
    dim = len(rows[0]["u"])
    mean = [sum(r["s"] * r["u"][i] for r in rows) / len(rows) for i in range(dim)]
    norm = math.sqrt(sum(v * v for v in mean)) or 1.0
    q = F.array(*[F.lit(v / norm) for v in mean])
    # cosine with a unit query vector = dot / ||v||: two O(dim) folds per row
    scored = vectors.where(~F.col("word").isin(*inputs)).select(
        "word", (V.dot("vector", q) / V.norm("vector")).alias("score")
    )
    return scored.orderBy(F.desc("score"), F.col("word")).limit(topn)


def hashed_word_vectors(words: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Fixture word vectors: ``word`` -> the ``embeddings`` row in slot ``md5(word)[:6] mod n``.

    ``n`` is the number of embeddings; a row's slot is ``vec_id mod n`` and the
    smallest id holds a slot that several share, so dense ids use every row.
    Words whose slot is empty have no vector.
    """
    n = max(embeddings.count(), 1)
    slot = F.pmod(F.col("vec_id"), F.lit(n)).alias("_slot")
    held = embeddings.select(slot, F.struct("vec_id", V.as_doubles("embedding").alias("vector")).alias("row"))
    held = held.groupBy("_slot").agg(F.min_by("row.vector", "row.vec_id").alias("vector"))
    wanted = F.pmod(F.conv(F.substring(F.md5(F.col("word")), 1, 6), 16, 10).cast("bigint"), F.lit(n))
    return words.select("word", wanted.alias("_slot")).join(sized_side(held), "_slot").select("word", "vector")
