from pyspark.sql import functions as F

from msgtriage.operators import filters, ingest, profile


def messages(spark):
    return spark.createDataFrame(
        [
            (1, "help food", None, "direct"),
            (2, "storm", "tormenta", "news"),
            (2, "storm", "tormenta", "news"),
            (3, "nothing here", None, "social"),
            (4, "water please", None, "direct"),
        ],
        "id long, message string, original string, genre string",
    )


def categories(spark):
    return spark.createDataFrame(
        [
            (1, "related-1;food-1;water-0;offer-0"),
            (2, "related-2;food-0;water-0;offer-0"),
            (2, "related-2;food-0;water-0;offer-0"),
            (3, "related-0;food-0;water-0;offer-0"),
            (4, "related-1;food-0;water-1;offer-0"),
            (5, "related-1;food-0;water-1;offer-0"),
        ],
        "id long, categories string",
    )


def test_counted_join(spark):
    out = ingest.join_messages_categories(messages(spark), categories(spark))
    rows = {r.id: r.n_pairs for r in out.collect()}
    assert rows == {1: 1, 2: 4, 3: 1, 4: 1}  # k x k pairs for the duplicated id


def test_clean_messages(spark):
    clean, labels = ingest.clean_messages(messages(spark), categories(spark))
    assert labels == ["related", "food", "water", "offer"]
    assert clean.columns == ["id", "message", "genre", *labels]
    rows = {r.id: r for r in clean.collect()}
    assert sorted(rows) == [1, 2, 3, 4]
    assert rows[2].related == 2 and rows[1].food == 1


def test_dedupe_first_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "z"), (1, None)], "id long, v string")
    out = {r.id: r.v for r in ingest.dedupe_first(df, "id", ["v"]).collect()}
    assert out == {1: None, 2: "z"}  # NULL sorts first


def test_duplicate_members(spark):
    out = ingest.duplicate_members(messages(spark), "id").collect()
    assert sorted((r.id, r.n_copies) for r in out) == [(2, 2), (2, 2)]


def test_training_filters(spark):
    clean, labels = ingest.clean_messages(messages(spark), categories(spark))
    train, kept = filters.prepare_training(clean, labels)
    assert sorted(r.id for r in train.collect()) == [1, 4]
    assert "offer" not in kept and "related" not in kept  # constant after filtering
    totals = {r.label: r.total for r in profile.label_totals(train, kept).collect()}
    assert totals == {"food": 1, "water": 1}


def test_all_zero_and_null_rows(spark):
    clean, labels = ingest.clean_messages(messages(spark), categories(spark))
    assert [r.id for r in filters.all_zero_rows(clean, labels).collect()] == [3]
    assert sorted(r.id for r in filters.null_rows(messages(spark), "original").collect()) == [1, 3, 4]


def test_value_counts_order(spark):
    rows = profile.value_counts(messages(spark), "genre").collect()
    assert [(r.genre, r.n) for r in rows] == [("direct", 2), ("news", 2), ("social", 1)]


def test_column_info(spark):
    rows = {r.column_name: r for r in profile.column_info(messages(spark)).collect()}
    assert rows["original"].n_null == 3 and rows["original"].non_null == 2
    assert rows["id"].dtype == "bigint" and rows["id"].n_distinct == 4


def test_genre_index_matches_string_indexer(spark):
    df = messages(spark)
    mapping = {r.genre: r.genre_index for r in filters.genre_index_frame(df).collect()}
    ml = {r.genre: int(r.genre_index) for r in filters.index_genre(df).select("genre", "genre_index").distinct().collect()}
    assert mapping == ml


def test_label_layout_summary(spark):
    df = spark.createDataFrame(
        [(1, "a-1;b-0"), (2, "a-0;c-1"), (3, None), (4, "a-1;b-1")], "id long, categories string"
    )
    r = ingest.label_layout_summary(df, ["a", "b"]).first()
    assert (r.n_rows, r.n_mismatched) == (4, 2)
