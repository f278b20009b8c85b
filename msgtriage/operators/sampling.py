"""Reproducible sampling, splitting and resampling (H0-H5).

All draws are functions of ``md5(seed:key)``, so results are identical across
runs, partitionings and engines (the DuckDB oracle computes the same hashes).

H0, the dense random index, avoids a global ``row_number()`` (which would
pull every row into one task): rows are spread over ``16**prefix_digits``
hash buckets, per-bucket counts (a bounded table) give prefix offsets, and a
``row_number`` runs inside each bucket only. Buckets are uniform because the
keys are hashed, so no bucket is hot even when the data is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def seeded_hash(seed: int | str, *parts: Column) -> Column:
    """``md5('seed:part1:part2...')`` as a hex string."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hex_prefix_int(h: Column, digits: int) -> Column:
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("bigint")


def dense_random_index_with_total(
    df: DataFrame,
    key: str | Sequence[str] = "id",
    seed: int = 42,
    out: str = "idx",
    prefix_digits: int = 4,
) -> tuple[DataFrame, int]:
    """H0: add ``out`` = 0..n-1 in the order of ``(md5(seed:key), key)``; also return n.

    Keys should be unique (run after D1). One pass counts rows per hash
    bucket; the count table has at most ``16**prefix_digits`` rows (65,536 by
    default, independent of the data size), so it is brought to the driver,
    turned into prefix offsets and broadcast back. A second pass numbers rows
    inside each bucket. Buckets are uniform because keys are hashed.
    """
    spark = df.sparkSession
    keys = _keys(key)
    h = seeded_hash(seed, *[F.col(k) for k in keys])
    hashed = df.withColumn("_h", h).withColumn("_b", hex_prefix_int(F.col("_h"), prefix_digits))
    counts = sorted(
        (int(r["_b"]), int(r["_n"]))
        for r in hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).collect()
    )
    rows, total = [], 0
    for b, n in counts:
        rows.append((b, total))
        total += n
    offsets = spark.createDataFrame(rows or [(0, 0)], "_b BIGINT, _off BIGINT")
    in_bucket = Window.partitionBy("_b").orderBy("_h", *keys)
    indexed = (
        hashed.join(F.broadcast(offsets), "_b")
        .withColumn(out, F.col("_off") + F.row_number().over(in_bucket) - 1)
        .drop("_h", "_b", "_off")
    )
    return indexed, total


def dense_random_index(
    df: DataFrame,
    key: str | Sequence[str] = "id",
    seed: int = 42,
    out: str = "idx",
    prefix_digits: int = 4,
) -> DataFrame:
    """H0 without the total (see ``dense_random_index_with_total``)."""
    return dense_random_index_with_total(df, key, seed, out, prefix_digits)[0]


def sample_rows(df: DataFrame, n: int, key: str | Sequence[str] = "id", seed: int = 42):
    """H1: ``n`` rows without replacement; ``n <= 0`` keeps all rows.

    Raises like pandas when ``n`` exceeds the row count.
    """
    if n <= 0:
        return df
    indexed, total = dense_random_index_with_total(df, key, seed, "_idx")
    if n > total:
        raise ValueError(f"cannot take a sample of {n} rows from {total}")
    return indexed.where(F.col("_idx") < n).drop("_idx")


def split_sizes(n: int, fractions: Sequence[float]) -> list[int]:
    """Exact part sizes: every part but the first is ``ceil(f * n)``, the first the rest."""
    import math

    tail = [math.ceil(f * n) for f in fractions[1:]]
    return [n - sum(tail), *tail]


def split_frame(
    df: DataFrame,
    fractions: Sequence[float] = (0.8, 0.2),
    names: Sequence[str] = ("train", "test"),
    key: str | Sequence[str] = "id",
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """H2: shuffled split with exact sizes (sklearn: ``n_test = ceil(f * n)``).

    Parts are contiguous ranges of the dense random index: the *last* parts
    (test, validation) come first in index order, the first part takes the rest.
    """
    indexed, n = dense_random_index_with_total(df, key, seed, "_idx")
    sizes = split_sizes(n, fractions)
    expr = None
    start = 0
    # index order: last part first
    for name, size in reversed(list(zip(names, sizes))):
        cond = F.col("_idx") < F.lit(start + size)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
        start += size
    return indexed.withColumn(out, expr).drop("_idx")


def assign_folds(
    df: DataFrame, k: int = 3, key: str | Sequence[str] = "id", seed: int = 11, out: str = "fold"
) -> DataFrame:
    """H3: shuffled k-fold; the first ``n mod k`` folds hold one extra row."""
    indexed, n = dense_random_index_with_total(df, key, seed, "_idx")
    q, r = divmod(n, k)
    idx = F.col("_idx")
    big = F.lit(r * (q + 1))
    fold = F.when(idx < big, F.floor(idx / F.lit(q + 1))).otherwise(
        F.lit(r) + F.floor((idx - big) / F.lit(max(q, 1)))
    )
    return indexed.withColumn(out, fold.cast("int")).drop("_idx")


def _draw_with_replacement(
    pool: DataFrame,
    n_pool: int,
    n_draw: int,
    key: Sequence[str],
    seed: int,
    tag: str,
    broadcast_rows: int,
) -> DataFrame:
    """``n_draw`` rows drawn uniformly with replacement from ``pool``.

    Draw ``d`` picks the pool row whose dense index is
    ``md5(seed:tag:d) mod n_pool``. The draws are generated distributed with
    ``spark.range`` and matched by an equi-join on the index. The pool side
    (whole rows, texts included) is broadcast only when its measured rows and
    bytes are within the bounds; otherwise both sides shuffle on the index,
    where a large pool means few draws per index value.
    """
    from msgtriage.operators.lexicon import sized_side

    spark = pool.sparkSession
    if n_draw > 0 and n_pool <= 0:
        raise ValueError(f"cannot draw {n_draw} rows ({tag}) from an empty class")
    if n_draw <= 0:
        return pool.limit(0).withColumn("draw", F.lit(None).cast("bigint"))
    indexed = dense_random_index(pool, key, seed, "_pick")
    draws = spark.range(n_draw).select(
        F.col("id").alias("draw"),
        (
            hex_prefix_int(seeded_hash(seed, F.lit(tag), F.col("id")), 15) % F.lit(n_pool)
        ).alias("_pick"),
    )
    side = sized_side(indexed, broadcast_rows) if n_pool <= broadcast_rows else indexed
    return draws.join(side, "_pick").drop("_pick")


def _class_counts(df: DataFrame, target: str) -> tuple[int, int]:
    row = df.agg(
        F.count_if(F.col(target) == 0).alias("neg"), F.count_if(F.col(target) == 1).alias("pos")
    ).first()
    return int(row["neg"]), int(row["pos"])


def upsample(
    df: DataFrame,
    target: str,
    fraction: float = 0.25,
    key: str | Sequence[str] = "id",
    seed: int = 11,
    broadcast_rows: int = 100_000,
) -> DataFrame:
    """H4: keep the negatives, add ``int(n_neg * fraction)`` positives drawn
    with replacement. Rows whose target is not 0/1 are dropped (Q9).

    Output has a ``draw`` column: -1 for kept rows, the draw number otherwise,
    so ``(key, draw)`` identifies every output row.
    """
    keys = _keys(key)
    n_neg, n_pos = _class_counts(df, target)
    n_draw = int(n_neg * fraction)
    kept = df.where(F.col(target) == 0).withColumn("draw", F.lit(-1).cast("bigint"))
    pool = df.where(F.col(target) == 1)
    drawn = _draw_with_replacement(pool, n_pos, n_draw, keys, seed, f"up:{target}", broadcast_rows)
    return kept.unionByName(drawn.select(*kept.columns))


def resample_negatives(
    df: DataFrame,
    target: str,
    fraction: float = 1.0,
    key: str | Sequence[str] = "id",
    seed: int = 11,
    broadcast_rows: int = 100_000,
) -> DataFrame:
    """H5: keep the positives, add ``int(n_pos * fraction)`` negatives drawn
    with replacement (the reference's "downsample"; honours ``target``)."""
    keys = _keys(key)
    n_neg, n_pos = _class_counts(df, target)
    n_draw = int(n_pos * fraction)
    kept = df.where(F.col(target) == 1).withColumn("draw", F.lit(-1).cast("bigint"))
    pool = df.where(F.col(target) == 0)
    drawn = _draw_with_replacement(
        pool, n_neg, n_draw, keys, seed, f"down:{target}", broadcast_rows
    )
    return kept.unionByName(drawn.select(*kept.columns))


def resample_training(
    df: DataFrame,
    upsample_targets: Sequence[str] = (),
    upsample_fraction: float = 0.9,
    downsample_target: str | None = None,
    downsample_fraction: float = 0.4,
    key: str = "id",
    seed: int = 11,
) -> DataFrame:
    """The reference's training resampling: several upsamples then one
    negative resample, applied in sequence. Each step's rows are keyed by a
    ``rowkey`` string so repeated draws of one message stay distinct.

    A step counts, indexes and draws from the rows of the step before it, so each step stores its
    narrow rows (keys and targets); texts and all other columns are joined to the last step's
    rows once. ``key`` must be unique, as for every sample (H0)."""
    from msgtriage.session import materialize

    targets = list(dict.fromkeys([*upsample_targets, *([downsample_target] if downsample_target is not None else [])]))
    narrow = df.select(F.col(key), F.col(key).cast("string").alias("rowkey"), *targets)
    step = 0
    for t in upsample_targets:
        narrow = materialize(_rekey(upsample(narrow, t, upsample_fraction, "rowkey", seed), step), "resampled")
        step += 1
    if downsample_target is not None:
        narrow = _rekey(resample_negatives(narrow, downsample_target, downsample_fraction, "rowkey", seed), step)
        narrow = materialize(narrow, "resampled")
    return narrow.select(key, "rowkey").join(df, key).select(*df.columns, "rowkey")


def _rekey(df: DataFrame, step: int) -> DataFrame:
    newkey = F.when(F.col("draw") < 0, F.col("rowkey")).otherwise(
        F.concat_ws("#", F.col("rowkey"), F.lit(str(step)), F.col("draw").cast("string"))
    )
    return df.withColumn("rowkey", newkey).drop("draw")
