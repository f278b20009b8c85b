"""Queries: text functions (I1-I11, I16) and relational features."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgtriage.functions import text as T
from msgtriage.operators import features, ingest
from msgtriage.session import by_key, ensure_parallelism
from msgtriage.plans.fixtures import categories_fx, table, with_fixtures
from msgtriage.plans.registry import r6, register
from msgtriage.plans.sqltext import initcap_sql, md5_int_sql, tokens_sql
from msgtriage.schema import EXTRA_STOP_WORDS, LABEL_KEYWORDS, URL_PATTERN, stop_words

#: Keyword list for the fixture: the reference keywords (which never occur in
#: the invented corpus) plus frequent non-stop-word corpus tokens.
FIXTURE_KEYWORDS = LABEL_KEYWORDS + ["de", "und", "que", "la", "der", "el"]

VOCAB = dict(vocab_size=2500, min_df=5, max_df=0.98)


def _docs(spark, sf_dir):
    return ensure_parallelism(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _doc_tokens(spark, sf_dir, variant="train"):
    return _docs(spark, sf_dir).select("doc_id", T.tokenize("text", variant).alias("tokens"))


def _toks_cte(variant="train"):
    return ("toks", f"SELECT doc_id, {tokens_sql('text', variant)} AS t FROM documents")


@register(
    "url_removal",
    ("I1",),
    f"SELECT page_id, regexp_replace(url, '{URL_PATTERN}', '', 'g') AS url_clean FROM pages",
)
def q_url_removal(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", T.remove_urls("url").alias("url_clean"))


@register(
    "message_tokens",
    ("I2", "I3", "I4", "I5", "I8", "C3", "U1"),
    with_fixtures(
        "SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS token_text FROM toks",
        ctes=(_toks_cte("train"),),
    ),
)
def q_message_tokens(spark, sf_dir):
    toks = _doc_tokens(spark, sf_dir, "train")
    return toks.select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("token_text")
    )


@register(
    "token_stats",
    ("I4",),
    with_fixtures(
        """SELECT count(*) AS n_tokens, count(DISTINCT token) AS n_distinct
           FROM (SELECT unnest(t) AS token FROM toks) u""",
        ctes=(_toks_cte(None),),
    ),
)
def q_token_stats(spark, sf_dir):
    toks = _doc_tokens(spark, sf_dir, None)
    return features.explode_tokens(toks, [], "tokens", "token").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.count_distinct("token").alias("n_distinct")
    )


def _variant_sql():
    parts = []
    for v in EXTRA_STOP_WORDS:
        parts.append(
            f"SELECT '{v}' AS variant, CAST(sum(len({tokens_sql('text', v)})) AS BIGINT) AS n_tokens "
            "FROM documents"
        )
    return "\nUNION ALL\n".join(parts)


@register("stopword_variants", ("I5", "I6"), _variant_sql())
def q_stopword_variants(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    # One scan: the letters-only split is shared, each variant filters it.
    words = docs.select(T.split_words(T.letters_only(T.remove_urls("text"))).alias("w"))
    sums = words.agg(
        *[
            F.sum(F.size(T.drop_words("w", stop_words(v)))).cast("bigint").alias(v)
            for v in EXTRA_STOP_WORDS
        ]
    )
    return sums.unpivot([], list(EXTRA_STOP_WORDS), "variant", "n_tokens")


@register(
    "sentence_counts",
    ("I9",),
    r"SELECT doc_id, CAST(len(regexp_split_to_array(text, '[.!?]\s+')) AS INTEGER) AS n_sentences FROM documents",
)
def q_sentence_counts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.size(T.sentences("text")).alias("n_sentences"))


@register(
    "split_note",
    ("I10",),
    """SELECT doc_id, split_part(concat(text, ' Note: translated from ', lang), 'Note', 1) AS kept
       FROM documents""",
)
def q_split_note(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    noted = F.concat("text", F.lit(" Note: translated from "), "lang")
    return docs.select("doc_id", T.split_note(noted).alias("kept"))


@register(
    "label_display_names",
    ("I16", "E2"),
    with_fixtures(
        f"""SELECT CAST(i AS INTEGER) AS pos, label,
                   {initcap_sql("replace(label, '_', ' ')")} AS display
            FROM (SELECT i, regexp_replace(string_split(categories, ';')[i], '[-0-9]', '', 'g') AS label
                  FROM (SELECT categories FROM categories_fx ORDER BY id, categories LIMIT 1) f,
                       range(1, 1 + len(string_split(f.categories, ';'))) r(i)) x""",
        "categories_fx",
    ),
)
def q_label_display(spark, sf_dir):
    names = ingest.label_name_frame(categories_fx(spark, sf_dir))
    return names.select(
        F.col("pos").cast("int").alias("pos"), "label", T.display_name("label").alias("display")
    )


def _keyword_sql():
    flags = ", ".join(f"CAST(list_contains(t, '{k}') AS INTEGER)" for k in FIXTURE_KEYWORDS)
    hits = " + ".join(f"CAST(list_contains(t, '{k}') AS INTEGER)" for k in FIXTURE_KEYWORDS)
    return with_fixtures(
        f"SELECT doc_id, concat({flags}) AS flags, {hits} AS n_hits FROM toks",
        ctes=(_toks_cte("train"),),
    )


@register("keyword_flags", ("I11",), _keyword_sql())
def q_keyword_flags(spark, sf_dir):
    toks = _doc_tokens(spark, sf_dir, "train")
    flags = T.keyword_flags("tokens", FIXTURE_KEYWORDS)
    return toks.select(
        "doc_id",
        F.array_join(F.transform(flags, lambda x: x.cast("string")), "").alias("flags"),
        F.aggregate(flags, F.lit(0), lambda a, x: a + x).alias("n_hits"),
    )


# --------------------------------------------------------------------------
# Relational features
# --------------------------------------------------------------------------


def _vocab_ctes(min_df="5", max_df="0.98 * n", limit="LIMIT 2500", variant="train"):
    return (
        _toks_cte(variant),
        ("tf", "SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM toks) u GROUP BY ALL"),
        ("nd", "SELECT count(*) AS n FROM documents"),
        ("stats", "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY term"),
        ("kept", f"SELECT term, df, cf FROM stats, nd WHERE df >= {min_df} AND df <= {max_df} ORDER BY cf DESC, term {limit}"),
        ("vocab", "SELECT term, df, cf, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_index FROM kept"),
    )


def _tf_and_vocab(spark, sf_dir, variant="train", **vocab_kw):
    docs = by_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    toks = docs.select("doc_id", T.tokenize("text", variant).alias("tokens"))
    n_docs = features.n_docs_of(table(spark, sf_dir, "documents"))
    tf = features.term_frequencies(toks, "doc_id")
    vocab = features.vocabulary(tf, n_docs, **vocab_kw)
    return tf, vocab, n_docs


@register(
    "term_vocabulary",
    ("J1",),
    with_fixtures("SELECT term, df, cf, term_index FROM vocab", ctes=_vocab_ctes()),
)
def q_term_vocabulary(spark, sf_dir):
    _, vocab, _ = _tf_and_vocab(spark, sf_dir, **VOCAB)
    return vocab.select("term", "df", "cf", F.col("term_index").cast("int").alias("term_index"))


@register(
    "tfidf_weights",
    ("J2", "J3", "J4"),
    with_fixtures(
        """SELECT doc_id, term, term_index,
                  round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight
           FROM (SELECT tf.doc_id, tf.term, v.term_index,
                        (1 + ln(tf.tf)) * (ln(CAST(1 + nd.n AS DOUBLE) / (1 + v.df)) + 1) AS w
                 FROM tf JOIN vocab v ON tf.term = v.term, nd) x""",
        ctes=_vocab_ctes(),
    ),
)
def q_tfidf_weights(spark, sf_dir):
    tf, vocab, n_docs = _tf_and_vocab(spark, sf_dir, **VOCAB)
    out = features.tfidf(tf, vocab, n_docs, "doc_id", sublinear=True, smooth=True, norm="l2",
                         vocab_size=VOCAB["vocab_size"])
    return out.select(
        "doc_id", "term", F.col("term_index").cast("int").alias("term_index"), r6("weight").alias("weight")
    )


@register(
    "tfidf_l1_weights",
    ("J1", "J2", "J4"),
    with_fixtures(
        """SELECT doc_id, term,
                  round(w / sum(abs(w)) OVER (PARTITION BY doc_id), 6) AS weight
           FROM (SELECT tf.doc_id, tf.term,
                        tf.tf * (ln(CAST(1 + nd.n AS DOUBLE) / (1 + v.df)) + 1) AS w
                 FROM tf JOIN vocab v ON tf.term = v.term, nd) x""",
        ctes=_vocab_ctes(min_df="0.01 * n", max_df="0.95 * n", limit="", variant="base"),
    ),
)
def q_tfidf_l1_weights(spark, sf_dir):
    tf, vocab, n_docs = _tf_and_vocab(
        spark, sf_dir, "base", vocab_size=None, min_df=0.01, max_df=0.95
    )
    out = features.tfidf(tf, vocab, n_docs, "doc_id", sublinear=False, smooth=True, norm="l1")
    return out.select("doc_id", "term", r6("weight").alias("weight"))


@register(
    "hashed_term_counts",
    ("J5",),
    with_fixtures(
        f"""SELECT doc_id, CAST({md5_int_sql('term', 8)} % 200 AS INTEGER) AS bucket, count(*) AS n
            FROM (SELECT doc_id, unnest(t) AS term FROM toks) u GROUP BY ALL""",
        ctes=(_toks_cte("base"),),
    ),
)
def q_hashed_term_counts(spark, sf_dir):
    toks = _doc_tokens(spark, sf_dir, "base")
    return features.hashed_term_counts(toks, "doc_id", "tokens", 200)


@register(
    "ngram_vocabulary",
    ("J6", "J1"),
    with_fixtures(
        """SELECT term, df, cf, term_index FROM vocab""",
        ctes=(
            ("toks0", f"SELECT doc_id, {tokens_sql('text', 'base')} AS t0 FROM documents"),
            ("toks", "SELECT doc_id, list_concat(t0, list_transform(range(1, len(t0)), lambda i: t0[i] || ' ' || t0[i + 1])) AS t FROM toks0"),
            *_vocab_ctes(min_df="5", max_df="n", limit="")[1:],
        ),
    ),
)
def q_ngram_vocabulary(spark, sf_dir):
    docs = by_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    uni = docs.select("doc_id", T.tokenize("text", "base").alias("tokens"))
    toks = uni.select("doc_id", features.unigrams_and_bigrams("tokens").alias("tokens"))
    n_docs = features.n_docs_of(table(spark, sf_dir, "documents"))
    tf = features.term_frequencies(toks, "doc_id")
    vocab = features.vocabulary(tf, n_docs, vocab_size=None, min_df=5, max_df=1.0)
    return vocab.select("term", "df", "cf", F.col("term_index").cast("int").alias("term_index"))


