from pyspark.sql import functions as F

from msgtriage.functions import labels as L
from msgtriage.functions import text as T
from msgtriage.schema import ENGLISH_STOP_WORDS, LABEL_KEYWORDS, stop_words


def one(spark, col_expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(col_expr(F.col("x")).alias("y")).first()["y"]


def test_tokenize_basic(spark):
    toks = one(spark, lambda c: T.tokenize(c, "train"),
               "We need FOOD and water!! http://a.b/c?d=1 thanks, 42 people")
    assert toks == ["need", "food", "water", "people"]


def test_tokenize_unicode_and_empty(spark):
    assert one(spark, lambda c: T.tokenize(c, None), "Ça été très bon") == ["a", "t", "tr", "s", "bon"]
    assert one(spark, lambda c: T.tokenize(c, "train"), "") == []
    assert one(spark, lambda c: T.tokenize(c, "train"), "   \n\t ") == []


def test_tokenize_idempotent(spark):
    text = "Storm hits the coast; 3 towns flooded. Please send help"
    once = one(spark, lambda c: T.tokenize(c, "train"), text)
    twice = one(spark, lambda c: T.tokenize(c, "train"), " ".join(once))
    assert once == twice


def test_url_removed_before_lowercase(spark):
    # case-sensitive pattern: an upper-case scheme is not a URL (reference behaviour)
    assert one(spark, T.remove_urls, "see https://x.org/a now") == "see  now"
    assert one(spark, T.remove_urls, "see HTTPS://x.org/a now") == "see HTTPS://x.org/a now"


def test_stop_word_variants():
    assert len(ENGLISH_STOP_WORDS) == 181 and set(ENGLISH_STOP_WORDS) <= set(stop_words("base"))
    # what punctuation removal leaves of contractions is dropped too
    assert {"re", "ve", "ll", "d", "didn", "isn", "won"} <= set(stop_words("base"))
    assert {"one", "see", "please"} <= set(stop_words("short"))
    assert {"here", "there", "their"} <= set(stop_words("train"))


def test_split_note_and_display(spark):
    assert one(spark, T.split_note, "help us Note: translated") == "help us "
    assert one(spark, T.split_note, "no marker") == "no marker"
    assert one(spark, T.display_name, "missing_people") == "Missing People"


def test_keyword_flags(spark):
    flags = one(spark, lambda c: T.keyword_flags(T.tokenize(c, "train")),
                "Food and water needed after the earthquake; medical products too")
    assert len(flags) == 33
    on = {k for k, f in zip(LABEL_KEYWORDS, flags) if f == 1}
    assert on == {"food", "water", "earthquake", "medical"}


def test_sentences(spark):
    assert one(spark, T.sentences, "One. Two! Three? Four") == ["One", "Two", "Three", "Four"]


def test_ragged_label_strings(spark):
    df = spark.createDataFrame(
        [("a-1;b-0",), ("a-1",), ("a-x;b-0",), ("",), (None,)], "categories string"
    )
    rows = df.select(L.label_at("categories", 0).alias("a"), L.label_at("categories", 1).alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [(1, 0), (1, None), (None, 0), (None, None), (None, None)]
    names = df.select(L.label_names("categories").alias("n")).first()["n"]
    assert names == ["a", "b"]
