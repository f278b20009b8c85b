"""ETL operators: join, label unpacking, duplicate handling, null filter.

Skew note: one ``id`` may hold a large share of all rows. Every per-key step
here is a hash aggregate (partial aggregation before the shuffle), never a
window or a ``collect_list`` over the key, and the clean table is built by
de-duplicating each side *before* the join, so duplicate ids never multiply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgtriage.functions.labels import label_at, label_fields, label_name, label_names


def dedupe_first(
    df: DataFrame, key: str | Sequence[str] = "id", order: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the first by ``order`` (then by the remaining columns).

    Implemented as ``min(struct(order..., rest...))`` per key: a hash/sort
    aggregate with a map-side partial step, so a hot key is collapsed inside
    each input partition before anything is shuffled. Deterministic, unlike
    ``dropDuplicates``. Ascending order, NULL sorts first.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order) if order is not None else [c for c in df.columns if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    first = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return first.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + rest]).select(
        *df.columns
    )


def duplicate_members(df: DataFrame, key: str = "id") -> DataFrame:
    """Every row whose key occurs more than once, with the group size.

    Counts are a partial-aggregated ``groupBy``; rows are matched back with an
    equi-join (AQE splits a hot key's partition instead of one task taking it).
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_copies")).where("n_copies > 1")
    return df.join(counts, key, "inner")


def duplicate_summary(df: DataFrame, key: str = "id") -> DataFrame:
    """D2 warning numbers: groups with copies and rows in such groups."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counts.agg(
        F.count(F.lit(1)).alias("dup_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("dup_rows")
    )


def join_messages_categories(messages: DataFrame, categories: DataFrame) -> DataFrame:
    """Inner equi-join on ``id`` in counted form.

    The reference's merge repeats each pair of rows sharing an id
    (k x k rows for k copies). Here each side first collapses identical rows
    with a count (map-side combine), the collapsed sides are joined, and
    ``n_pairs`` carries how many joined rows each output row stands for.
    Nothing is dropped: expanding every row ``n_pairs`` times gives the full
    merge, but exact copies are never multiplied inside the cluster.
    """
    m = messages.groupBy(*messages.columns).agg(F.count(F.lit(1)).alias("_m_n"))
    c = categories.groupBy(*categories.columns).agg(F.count(F.lit(1)).alias("_c_n"))
    cols = list(dict.fromkeys(messages.columns + categories.columns))
    return m.join(c, "id", "inner").select(
        *cols, (F.col("_m_n") * F.col("_c_n")).alias("n_pairs")
    )


def label_name_frame(categories: DataFrame) -> DataFrame:
    """E2 as a DataFrame ``(pos, label)`` from the row with the smallest id."""
    first = (
        categories.where(F.col("categories").isNotNull())
        .orderBy("id", "categories")
        .limit(1)
    )
    return first.select(F.posexplode(label_fields("categories")).alias("pos0", "field")).select(
        (F.col("pos0") + 1).alias("pos"), label_name(F.col("field")).alias("label")
    )


def discover_label_names(categories: DataFrame) -> list[str]:
    """Label names from the first row (one tiny top-1 job)."""
    first = (
        categories.where(F.col("categories").isNotNull())
        .orderBy("id", "categories")
        .limit(1)
        .select(label_names("categories").alias("names"))
        .first()
    )
    if first is None:
        raise ValueError("categories table is empty")
    return list(first["names"])


def _layout_mismatch(labels: Sequence[str]):
    expected = F.array(*[F.lit(x) for x in labels])
    return F.col("categories").isNull() | ~(label_names("categories") == expected)


def label_layout_mismatches(categories: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rows whose packed string does not carry exactly ``labels`` in order."""
    return categories.where(_layout_mismatch(labels))


def label_layout_summary(categories: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Q4 check in one pass: ``(n_rows, n_mismatched)``."""
    return categories.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(_layout_mismatch(labels)).alias("n_mismatched")
    )


def unpack_labels(
    df: DataFrame, labels: Sequence[str], source: str = "categories", drop_source: bool = True
) -> DataFrame:
    """E1 + E3: one INT column per label, positional, no shuffle (no pivot)."""
    out = df.withColumns({name: label_at(source, i) for i, name in enumerate(labels)})
    return out.drop(source) if drop_source else out


def labels_long(df: DataFrame, labels: Sequence[str], key: str | Sequence[str] = "id") -> DataFrame:
    """``(key, label, y)`` long form of the wide label columns."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.unpivot(keys, list(labels), "label", "y")


def drop_null_labels(df: DataFrame, label: str = "related") -> DataFrame:
    """Drop rows whose ``label`` is NULL."""
    return df.dropna(subset=[label])


def clean_messages(
    messages: DataFrame,
    categories: DataFrame,
    labels: Sequence[str] | None = None,
    message_order: Sequence[str] = ("message", "original", "genre"),
) -> tuple[DataFrame, list[str]]:
    """The ETL plan (T1 + T2 -> T3).

    join -> unpack -> keep first per id -> drop ``original`` -> drop NULL
    ``related``. Keep-first is lexicographic on (message side, label side), so
    the first row of the joined group equals (first message, first label
    string); both sides are therefore reduced to one row per id before the
    join, which is then one-to-one. One shuffle per side on ``id``, no
    exchange for the join (both sides arrive hash-partitioned on ``id``).
    """
    if labels is None:
        labels = discover_label_names(categories)
    labels = list(labels)
    c1 = dedupe_first(categories.select("id", "categories"), "id", ["categories"])
    # messages without labels go before their texts are compared
    labelled = messages.join(categories.select("id"), "id", "left_semi")
    m1 = dedupe_first(labelled.select("id", *message_order), "id", list(message_order))
    joined = m1.join(c1, "id", "inner")
    unpacked = unpack_labels(joined, labels).drop("original")
    clean = drop_null_labels(unpacked, labels[0])
    return clean.select("id", "message", "genre", *labels), labels
