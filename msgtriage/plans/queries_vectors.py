"""Queries: word vectors (A7, J8, G3), sentence vectors (J9) and the median fill."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgtriage.functions import vectors as V
from msgtriage.operators import features, vectors
from msgtriage.session import by_key, ensure_parallelism
from msgtriage.plans.fixtures import table, with_fixtures
from msgtriage.plans.registry import r6, register
from msgtriage.plans.sqltext import tokens_sql
from msgtriage.session import materialize, scratch_path
from msgtriage.sources import files

MIN_COUNT = 5
DIM = 64
POSITIVE = ["de", "und"]
NEGATIVE = ["que"]


def _doc_tokens(spark, sf_dir, spread=ensure_parallelism):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return features.with_tokens(docs, "text", "tokens", "train")


def _word_vectors(spark, sf_dir, toks=None):
    """The fixture word-vector table (T7), materialised once per query.

    Several jobs read it (size check, joins, the query vector); writing it to
    the shared checkpoint folder cuts the lineage so the corpus is tokenised
    for it once, and the table survives executor loss.
    """
    toks = toks if toks is not None else _doc_tokens(spark, sf_dir)
    counts = features.token_table(toks, "doc_id").groupBy(F.col("token").alias("word")).agg(
        F.count(F.lit(1)).alias("c")
    )
    vocab = counts.where(F.col("c") >= MIN_COUNT).select("word")
    wv = vectors.hashed_word_vectors(vocab, table(spark, sf_dir, "embeddings"))
    return materialize(wv, "word-vectors")


def _vec_ctes():
    return (
        ("toks", f"SELECT doc_id, {tokens_sql('text', 'train')} AS t FROM documents"),
        ("wc", "SELECT w AS word, count(*) AS c FROM (SELECT unnest(t) AS w FROM toks) x GROUP BY w"),
        ("vocab", f"SELECT word FROM wc WHERE c >= {MIN_COUNT}"),
        ("vecs", """SELECT v.word, list_transform(e.embedding, lambda x: CAST(x AS DOUBLE)) AS vector
                    FROM vocab v JOIN embeddings e
                      ON e.vec_id = CAST(('0x' || substr(md5(v.word), 1, 6)) AS BIGINT) % (SELECT count(*) FROM embeddings)"""),
        ("hits", """SELECT x.doc_id, x.pos, x.word, v.vector FROM
                    (SELECT doc_id, unnest(t) AS word, unnest(range(1, len(t) + 1)) AS pos FROM toks) x
                    JOIN vecs v ON x.word = v.word"""),
    )


@register(
    "word_vectors_text",
    ("A7", "J8"),
    with_fixtures(
        """SELECT word, CAST(len(vector) AS INTEGER) AS dim, round(list_sum(vector), 6) AS v_sum,
                  round(sqrt(list_sum(list_transform(vector, lambda x: x * x))), 6) AS v_norm
           FROM vecs""",
        ctes=_vec_ctes()[:4],
    ),
)
def q_word_vectors_text(spark, sf_dir):
    path = scratch_path(spark, "word-vectors")
    files.write_word_vectors(_word_vectors(spark, sf_dir), path)
    back = files.read_word_vectors(spark, path, DIM)
    return back.select(
        "word", F.size("vector").alias("dim"), r6(V.vsum("vector")).alias("v_sum"),
        r6(V.norm("vector")).alias("v_norm"),
    )


@register(
    "word_vector_lookup",
    ("J8", "C4"),
    with_fixtures(
        """SELECT doc_id, count(*) AS n_found, round(sum(list_sum(vector)), 6) AS v_sum
           FROM hits GROUP BY doc_id""",
        ctes=_vec_ctes(),
    ),
)
def q_word_vector_lookup(spark, sf_dir):
    toks = _doc_tokens(spark, sf_dir)
    wv = _word_vectors(spark, sf_dir, toks)
    # summarise each vector once on the (small) vocabulary side, not per token
    summary = wv.select("word", F.array(V.vsum("vector")).alias("vector"))
    hits = vectors.lookup_vectors(toks, summary, "doc_id", "tokens")
    return hits.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_found"), r6(F.sum(F.col("vector")[0])).alias("v_sum")
    )


def _in_list(words):
    return ", ".join(f"'{w}'" for w in words)


@register(
    "similar_words",
    ("G3",),
    with_fixtures(
        f"""SELECT word, round(list_inner_product(list_transform(vector, lambda x: x / nrm), q), 6) AS score
            FROM (SELECT word, vector, sqrt(list_sum(list_transform(vector, lambda x: x * x))) AS nrm
                  FROM vecs WHERE word NOT IN ({_in_list(POSITIVE + NEGATIVE)})) v, qv
            ORDER BY list_inner_product(list_transform(vector, lambda x: x / nrm), q) DESC, word
            LIMIT 10""",
        ctes=(
            *_vec_ctes()[:4],
            ("units", f"""SELECT CASE WHEN word IN ({_in_list(POSITIVE)}) THEN 1.0 ELSE -1.0 END AS s, vector,
                                 sqrt(list_sum(list_transform(vector, lambda x: x * x))) AS nrm
                          FROM vecs WHERE word IN ({_in_list(POSITIVE + NEGATIVE)})"""),
            ("comps", "SELECT i, sum(s * vector[i] / nrm) / count(*) AS m FROM units, range(1, len(units.vector) + 1) r(i) GROUP BY i"),
            ("qv", "SELECT list(m / (SELECT sqrt(sum(m * m)) FROM comps) ORDER BY i) AS q FROM comps"),
        ),
    ),
)
def q_similar_words(spark, sf_dir):
    wv = _word_vectors(spark, sf_dir)
    top = vectors.most_similar(wv, POSITIVE, NEGATIVE, 10)
    return top.select("word", r6("score").alias("score"))


@register(
    "sentence_vectors",
    ("J9",),
    with_fixtures(
        """SELECT d.doc_id, round(coalesce(p.v_sum, 0.0), 6) AS v_sum, round(coalesce(p.v_norm, 0.0), 6) AS v_norm
           FROM documents d LEFT JOIN (
             SELECT doc_id, sum(c) AS v_sum, sqrt(sum(c * c)) AS v_norm FROM (
               SELECT doc_id, i, sum(vector[i] * pow(64.0, -r)) AS c
               FROM (SELECT doc_id, vector, row_number() OVER (PARTITION BY doc_id ORDER BY pos DESC) AS r FROM hits) h,
                    range(1, 65) g(i)
               GROUP BY doc_id, i) c
             GROUP BY doc_id) p ON d.doc_id = p.doc_id""",
        ctes=_vec_ctes(),
    ),
)
def q_sentence_vectors(spark, sf_dir):
    toks = _doc_tokens(spark, sf_dir, lambda docs: by_key(docs, "doc_id"))
    sv = vectors.sentence_vectors(toks, _word_vectors(spark, sf_dir, toks), DIM, "doc_id", "tokens")
    return sv.select("doc_id", r6(V.vsum("sentvec")).alias("v_sum"), r6(V.norm("sentvec")).alias("v_norm"))


@register(
    "median_fill",
    ("F13",),
    with_fixtures(
        """SELECT d.doc_id,
                  CAST(CASE WHEN a.doc_id IS NULL THEN 64 ELSE 0 END AS INTEGER) AS n_filled,
                  round(CASE WHEN a.doc_id IS NULL THEN 64 * (SELECT med FROM md) ELSE a.v_sum END, 6) AS v_sum
           FROM documents d LEFT JOIN (SELECT doc_id, sum(c) AS v_sum FROM comp GROUP BY doc_id) a
             ON d.doc_id = a.doc_id""",
        ctes=(
            *_vec_ctes(),
            ("comp", "SELECT doc_id, i, avg(vector[i]) AS c FROM hits, range(1, 65) g(i) GROUP BY doc_id, i"),
            ("md", "SELECT median(c) AS med FROM comp"),
        ),
    ),
)
def q_median_fill(spark, sf_dir):
    toks = _doc_tokens(spark, sf_dir)
    mv = vectors.mean_vectors(toks, _word_vectors(spark, sf_dir, toks), DIM, "doc_id", "tokens")
    n_nan = F.size(F.filter("meanvec", lambda x: F.isnan(x)))
    marked = mv.select("doc_id", n_nan.alias("n_filled"), "meanvec")
    filled, _ = vectors.fill_nan_global_median(marked, "meanvec", exact=True)
    return filled.select("doc_id", "n_filled", r6(V.vsum("meanvec")).alias("v_sum"))
