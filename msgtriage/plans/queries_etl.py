"""Queries: ETL, filters and profiling (A, B, C, D, E, F1-F8, G1-G2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgtriage.operators import filters, ingest, profile
from msgtriage.plans import etl
from msgtriage.plans.fixtures import categories_fx, messages_fx, with_fixtures
from msgtriage.plans.registry import r6, register


# ==========================================================================
# ETL (A1-A6 via plans, C1, E1-E4, D1-D2, B5)
# ==========================================================================


@register(
    "clean_table",
    ("C1", "C2", "E1", "E2", "E3", "D1", "B2", "B5"),
    with_fixtures("SELECT * FROM clean_fx", "clean_fx"),
)
def q_clean_table(spark, sf_dir):
    clean, _ = etl.clean_table(spark, sf_dir)
    return clean


@register(
    "joined_pairs",
    ("C1",),
    with_fixtures(
        """SELECT m.id, m.message, m.original, m.genre, c.categories,
                  count(*) AS n_pairs
           FROM messages_fx m JOIN categories_fx c ON m.id = c.id
           GROUP BY ALL""",
        "messages_fx",
        "categories_fx",
    ),
)
def q_joined_pairs(spark, sf_dir):
    return ingest.join_messages_categories(messages_fx(spark, sf_dir), categories_fx(spark, sf_dir))


@register(
    "label_names",
    ("E2",),
    with_fixtures(
        """SELECT CAST(i AS INTEGER) AS pos,
                  regexp_replace(string_split(categories, ';')[i], '[-0-9]', '', 'g') AS label
           FROM (SELECT categories FROM categories_fx ORDER BY id, categories LIMIT 1) f,
                range(1, 1 + len(string_split(f.categories, ';'))) r(i)""",
        "categories_fx",
    ),
)
def q_label_names(spark, sf_dir):
    return ingest.label_name_frame(categories_fx(spark, sf_dir)).select(
        F.col("pos").cast("int").alias("pos"), "label"
    )


@register(
    "unpacked_labels",
    ("E1", "E3"),
    with_fixtures(
        """SELECT id,
              TRY_CAST(right(split_part(categories, ';', 1), 1) AS INTEGER) AS related,
              TRY_CAST(right(split_part(categories, ';', 2), 1) AS INTEGER) AS toxic,
              TRY_CAST(right(split_part(categories, ';', 3), 1) AS INTEGER) AS long,
              TRY_CAST(right(split_part(categories, ';', 4), 1) AS INTEGER) AS multi_line,
              TRY_CAST(right(split_part(categories, ';', 5), 1) AS INTEGER) AS child_alone
           FROM categories_fx""",
        "categories_fx",
    ),
)
def q_unpacked_labels(spark, sf_dir):
    cats = categories_fx(spark, sf_dir)
    labels = ingest.discover_label_names(cats)
    return ingest.unpack_labels(cats, labels)


@register(
    "duplicate_members",
    ("D2",),
    with_fixtures(
        """SELECT id, genre, n_copies FROM (
             SELECT id, genre, CAST(count(*) OVER (PARTITION BY id) AS BIGINT) AS n_copies
             FROM messages_fx) t
           WHERE n_copies > 1""",
        "messages_fx",
    ),
)
def q_duplicate_members(spark, sf_dir):
    m = messages_fx(spark, sf_dir).select("id", "genre")
    return ingest.duplicate_members(m, "id").select("id", "genre", "n_copies")


@register(
    "duplicate_summary",
    ("D2",),
    with_fixtures(
        """SELECT CAST(count(*) AS BIGINT) AS dup_keys,
                  CAST(coalesce(sum(n), 0) AS BIGINT) AS dup_rows
           FROM (SELECT id, count(*) AS n FROM categories_fx GROUP BY id HAVING count(*) > 1) t""",
        "categories_fx",
    ),
)
def q_duplicate_summary(spark, sf_dir):
    return ingest.duplicate_summary(categories_fx(spark, sf_dir), "id").select(
        F.col("dup_keys").cast("bigint").alias("dup_keys"),
        F.col("dup_rows").cast("bigint").alias("dup_rows"),
    )


@register(
    "labels_long",
    ("E4",),
    with_fixtures(
        """SELECT id, 'related' AS label, related AS y FROM training_fx
           UNION ALL SELECT id, 'toxic', toxic FROM training_fx
           UNION ALL SELECT id, 'long', long FROM training_fx
           UNION ALL SELECT id, 'multi_line', multi_line FROM training_fx""",
        "training_fx",
    ),
)
def q_labels_long(spark, sf_dir):
    train, labels = etl.training_table(spark, sf_dir)
    return ingest.labels_long(train, labels, "id")


# ==========================================================================
# Filters (B1-B10)
# ==========================================================================


@register(
    "training_rows",
    ("B1", "B3", "B4", "B6"),
    with_fixtures(
        "SELECT id, message, genre, related, toxic, long, multi_line FROM training_fx",
        "training_fx",
    ),
)
def q_training_rows(spark, sf_dir):
    train, labels = etl.training_table(spark, sf_dir)
    return filters.select_features(train, labels)


@register(
    "combined_label_values",
    ("B7", "D4"),
    with_fixtures("SELECT DISTINCT related + toxic AS combined FROM training_fx", "training_fx"),
)
def q_combined(spark, sf_dir):
    train, _ = etl.training_table(spark, sf_dir)
    return filters.combined_label_values(train, "related", "toxic")


@register(
    "all_zero_rows",
    ("B8",),
    with_fixtures(
        """SELECT id, genre FROM clean_fx
           WHERE related = 0 AND toxic = 0 AND long = 0 AND multi_line = 0 AND child_alone = 0""",
        "clean_fx",
    ),
)
def q_all_zero(spark, sf_dir):
    clean, labels = etl.clean_table(spark, sf_dir)
    return filters.all_zero_rows(clean, labels).select("id", "genre")


@register(
    "null_original_rows",
    ("B10",),
    with_fixtures("SELECT id, genre FROM messages_fx WHERE original IS NULL", "messages_fx"),
)
def q_null_rows(spark, sf_dir):
    return filters.null_rows(messages_fx(spark, sf_dir), "original").select("id", "genre")


@register(
    "genre_index",
    ("B9",),
    with_fixtures(
        """SELECT genre, CAST(row_number() OVER (ORDER BY n DESC, genre) - 1 AS INTEGER) AS genre_index, n
           FROM (SELECT genre, count(*) AS n FROM training_fx WHERE genre IS NOT NULL GROUP BY genre) t""",
        "training_fx",
    ),
)
def q_genre_index(spark, sf_dir):
    train, _ = etl.training_table(spark, sf_dir)
    return filters.genre_index_frame(train, "genre").select(
        "genre", F.col("genre_index").cast("int").alias("genre_index"), "n"
    )


@register(
    "genre_one_hot",
    ("B9",),
    with_fixtures(
        """SELECT t.id, coalesce(g.slot, 0) AS slot, w.width
           FROM training_fx t
           LEFT JOIN (SELECT genre, CAST(row_number() OVER (ORDER BY n DESC, genre) AS INTEGER) AS slot
                      FROM (SELECT genre, count(*) AS n FROM training_fx WHERE genre IS NOT NULL GROUP BY genre) c) g ON t.genre = g.genre
           CROSS JOIN (SELECT CAST(count(DISTINCT genre) AS INTEGER) AS width FROM training_fx) w""",
        "training_fx",
    ),
)
def q_genre_one_hot(spark, sf_dir):
    """The place of the 1 in each row's one-hot genre (0: no genre, all zeros) and the vector's length."""
    from pyspark.ml.functions import vector_to_array

    train, _ = etl.training_table(spark, sf_dir)
    hot = filters.index_genre(train, "genre", one_hot=True).select("id", vector_to_array("genre_vec").alias("v"))
    return hot.select("id", F.array_position("v", F.lit(1.0)).cast("int").alias("slot"), F.size("v").alias("width"))


# ==========================================================================
# Profiling
# ==========================================================================


@register(
    "genre_counts",
    ("F3", "G1"),
    with_fixtures(
        "SELECT genre, count(*) AS n FROM training_fx WHERE genre IS NOT NULL GROUP BY genre",
        "training_fx",
    ),
)
def q_genre_counts(spark, sf_dir):
    train, _ = etl.training_table(spark, sf_dir)
    return profile.value_counts(train, "genre")


@register(
    "label_totals",
    ("F4", "G1", "B6"),
    with_fixtures(
        """SELECT 'related' AS label, CAST(sum(related) AS BIGINT) AS total FROM training_fx
           UNION ALL SELECT 'toxic', CAST(sum(toxic) AS BIGINT) FROM training_fx
           UNION ALL SELECT 'long', CAST(sum(long) AS BIGINT) FROM training_fx
           UNION ALL SELECT 'multi_line', CAST(sum(multi_line) AS BIGINT) FROM training_fx""",
        "training_fx",
    ),
)
def q_label_totals(spark, sf_dir):
    train, labels = etl.training_table(spark, sf_dir)
    return profile.label_totals(train, labels)


def _column_profile_sql() -> str:
    cols = [("id", "bigint"), ("message", "string"), ("original", "string"), ("genre", "string")]
    parts = [
        f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS dtype,
                   count({c}) AS non_null, count(*) - count({c}) AS n_null,
                   count(DISTINCT {c}) AS n_distinct FROM messages_fx"""
        for i, (c, t) in enumerate(cols)
    ]
    return with_fixtures("\nUNION ALL\n".join(parts), "messages_fx")


@register("column_profile", ("F1", "F2", "F8"), _column_profile_sql())
def q_column_profile(spark, sf_dir):
    return profile.column_info(messages_fx(spark, sf_dir))


@register(
    "null_counts",
    ("F2",),
    with_fixtures(
        """SELECT 'id' AS column_name, count(*) - count(id) AS n_null FROM messages_fx
           UNION ALL SELECT 'message', count(*) - count(message) FROM messages_fx
           UNION ALL SELECT 'original', count(*) - count(original) FROM messages_fx
           UNION ALL SELECT 'genre', count(*) - count(genre) FROM messages_fx""",
        "messages_fx",
    ),
)
def q_null_counts(spark, sf_dir):
    return profile.null_counts(messages_fx(spark, sf_dir))


@register(
    "distinct_counts",
    ("F1",),
    with_fixtures(
        """SELECT 'genre' AS column_name, count(DISTINCT genre) AS n_distinct FROM clean_fx
           UNION ALL SELECT 'related', count(DISTINCT related) FROM clean_fx
           UNION ALL SELECT 'toxic', count(DISTINCT toxic) FROM clean_fx
           UNION ALL SELECT 'long', count(DISTINCT long) FROM clean_fx
           UNION ALL SELECT 'multi_line', count(DISTINCT multi_line) FROM clean_fx
           UNION ALL SELECT 'child_alone', count(DISTINCT child_alone) FROM clean_fx""",
        "clean_fx",
    ),
)
def q_distinct_counts(spark, sf_dir):
    clean, labels = etl.clean_table(spark, sf_dir)
    return profile.distinct_counts(clean, ["genre", *labels])


@register(
    "label_prevalence",
    ("F5",),
    with_fixtures(
        """SELECT b.label, round(b.p, 6) AS before, round(a.p, 6) AS after FROM
           (SELECT 'related' AS label, avg(related) AS p FROM clean_fx
            UNION ALL SELECT 'toxic', avg(toxic) FROM clean_fx
            UNION ALL SELECT 'long', avg(long) FROM clean_fx
            UNION ALL SELECT 'multi_line', avg(multi_line) FROM clean_fx) b
           JOIN
           (SELECT 'related' AS label, avg(related) AS p FROM training_fx
            UNION ALL SELECT 'toxic', avg(toxic) FROM training_fx
            UNION ALL SELECT 'long', avg(long) FROM training_fx
            UNION ALL SELECT 'multi_line', avg(multi_line) FROM training_fx) a
           ON a.label = b.label""",
        "training_fx",
    ),
)
def q_label_prevalence(spark, sf_dir):
    clean, _ = etl.clean_table(spark, sf_dir)
    train, kept = etl.training_table(spark, sf_dir)
    out = profile.prevalence_change(clean, train, kept)
    return out.select("label", r6("before").alias("before"), r6("after").alias("after"))


@register(
    "label_histogram",
    ("F6",),
    with_fixtures(
        """SELECT related + toxic + long + multi_line + child_alone AS n_labels,
                  count(*) AS n_rows
           FROM clean_fx GROUP BY 1""",
        "clean_fx",
    ),
)
def q_label_histogram(spark, sf_dir):
    clean, labels = etl.clean_table(spark, sf_dir)
    return profile.label_count_histogram(clean, labels)


@register(
    "shape_report",
    ("F7",),
    with_fixtures(
        """SELECT count(*) AS n_rows, CAST(1 AS INTEGER) AS n_feature_cols,
                  CAST(4 AS INTEGER) AS n_label_cols FROM training_fx""",
        "training_fx",
    ),
)
def q_shape_report(spark, sf_dir):
    train, labels = etl.training_table(spark, sf_dir)
    return profile.shape_report(train, labels)


@register(
    "distinct_genres",
    ("D4",),
    with_fixtures("SELECT DISTINCT genre FROM messages_fx", "messages_fx"),
)
def q_distinct_genres(spark, sf_dir):
    return profile.distinct_values(messages_fx(spark, sf_dir), "genre")


@register(
    "head_rows",
    ("G2",),
    with_fixtures(
        "SELECT id, genre, related FROM clean_fx ORDER BY id LIMIT 5", "clean_fx"
    ),
)
def q_head_rows(spark, sf_dir):
    clean, _ = etl.clean_table(spark, sf_dir)
    return profile.head_rows(clean.select("id", "genre", "related"), 5, ["id"])


@register(
    "label_layout_check",
    ("E2", "E1"),
    with_fixtures(
        """SELECT count(*) AS n_rows,
                  count(*) FILTER (WHERE list_transform(string_split(categories, ';'),
                                          lambda f: regexp_replace(f, '[-0-9]', '', 'g'))
                                   <> ['related', 'toxic', 'long', 'multi_line', 'child_alone']
                                   OR categories IS NULL) AS n_mismatched
           FROM categories_fx""",
        "categories_fx",
    ),
)
def q_label_layout_check(spark, sf_dir):
    """Q4: every packed string must carry the names found in the first row, in order."""
    cats = categories_fx(spark, sf_dir)
    return ingest.label_layout_summary(cats, ingest.discover_label_names(cats))
