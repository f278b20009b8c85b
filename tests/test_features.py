import pytest
from pyspark.sql import functions as F

from msgtriage.operators import features, lexicon, models
from msgtriage.plans.catalog import REGISTRY


def test_ordered_index_matches_global_sort(spark):
    words = ["apple", "ap", "b", "banana", "zeta", "a", "apricot", "appletree", "", "zz", "zeta2"]
    df = spark.createDataFrame([(w,) for w in words], "term string")
    got = {r.term: r.idx for r in features.ordered_index(df, "term", "idx").collect()}
    assert got == {w: i for i, w in enumerate(sorted(words))}


def test_vocabulary_bounds_and_ties(spark):
    rows = [(1, ["a", "b", "c"]), (2, ["a", "b"]), (3, ["a", "c", "c"]), (4, ["d"])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    tf = features.term_frequencies(df, "id")
    v = {r.term: (r.df, r.cf, r.term_index) for r in features.vocabulary(tf, 4, 2, 2, 1.0).collect()}
    # df >= 2: a(3, cf 3), b(2, cf 2), c(2, cf 3); top-2 by cf then term: a, c
    assert v == {"a": (3, 3, 0), "c": (2, 3, 1)}


def test_tfidf_rows_have_unit_norm(spark):
    rows = [(1, ["a", "b", "b"]), (2, ["a", "c"]), (3, ["c", "c", "c", "b"])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    tf = features.term_frequencies(df, "id")
    vocab = features.vocabulary(tf, 3, None, 1, 1.0)
    w = features.tfidf(tf, vocab, 3, "id")
    norms = w.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n")).collect()
    assert all(abs(r.n - 1.0) < 1e-12 for r in norms)


def test_more_terms_than_an_ml_vector_holds_are_an_error(spark, monkeypatch):
    df = spark.createDataFrame([("alpha beta gamma",)] * 5 + [("delta beta",)] * 5 + [("alpha",)], "message string")
    assert sum(len(s.vocabulary) for s in models.featurizer("union").fit(df).stages if hasattr(s, "vocabulary")) == 4
    monkeypatch.setattr(features, "ML_TERMS", 3)
    with pytest.raises(ValueError, match="more than 3 terms"):
        models.featurizer("union").fit(df)


def test_fitted_tfidf_has_no_vocabulary_limit(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(features, "ML_TERMS", 3, raising=False)
    monkeypatch.setattr(models, "UNCAPPED", 3, raising=False)  # the former limit
    rows = [(k, "apple banana cherries lemon") for k in range(6)] + [(k, "water apple") for k in range(6, 12)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = REGISTRY["fitted_tfidf"].fn(spark, str(tmp_path)).collect()
    assert {r.term for r in got if r.id == 0} == {"banana", "cherrie", "lemon"}  # apple: in all documents
    assert {r.term: r.weight for r in got if r.id == 6} == {"water": 1.0}
    assert len(got) == 24


def test_sized_side_bounds(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("w"))
    n, b = lexicon.measured_size(df)
    assert n == 1000 and b > 8000
    assert lexicon.should_broadcast(df, 10_000, 10**9)
    assert not lexicon.should_broadcast(df, 10, 10**9)
    assert not lexicon.should_broadcast(df, 10_000, 100)


def test_texts_moved_by_key_are_counted_and_weighed_in_place(spark):
    from msgtriage.session import by_key

    docs = spark.createDataFrame([(1, "a b b"), (1, "b"), (2, "a c"), (None, "c")], "id int, text string")
    tf = features.term_frequencies(by_key(docs, "id").select("id", F.split("text", " ").alias("tokens")), "id")
    vocab = spark.createDataFrame([("a", 2, 0), ("b", 2, 1)], "term string, df int, term_index int")
    w = features.tfidf(tf, vocab, 3, "id", vocab_size=2)
    assert w._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {(r.id, r.term, r.tf) for r in tf.collect()} == {(1, "a", 1), (1, "b", 3), (2, "a", 1), (2, "c", 1), (None, "c", 1)}
