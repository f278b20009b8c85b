"""Queries: model training, prediction and evaluation.

Model fits have no SQL form; these queries get the rows-only check. Their
metrics arithmetic is checked exactly by the fixed-prediction queries.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from msgtriage.operators import features, metrics, models, sampling
from msgtriage.plans import etl
from msgtriage.plans.fixtures import table, with_fixtures
from msgtriage.plans.queries_sampling import _FOLD_SQL, FOLD_SEED, _idx_sql
from msgtriage.plans.registry import r6, register
from msgtriage.plans.sqltext import tokens_sql
from msgtriage.session import by_key, materialize, scratch_path
from msgtriage.sources.models import load_model, save_model

SEED = 42


def _split(spark, sf_dir):
    train, labels = etl.training_table(spark, sf_dir)
    split = sampling.split_frame(train, (0.8, 0.2), ("train", "test"), "id", SEED)
    return (
        split.where(F.col("split") == "train").drop("split"),
        split.where(F.col("split") == "test").drop("split"),
        labels,
    )


@register("multilabel_predictions", ("K1", "K2", "K13", "A8", "J1", "J2", "J4", "U2", "U3", "U4"))
def q_multilabel_predictions(spark, sf_dir):
    """TF-IDF + balanced logistic regression per label; saved, reloaded, scored."""
    train, test, labels = _split(spark, sf_dir)
    model, _ = models.fit_multilabel(train, labels, "tfidf", "logistic", clf_params={"C": 0.01})
    path = scratch_path(spark, "model")
    save_model(model, path, labels)
    loaded, names = load_model(spark, path)
    return models.predict_long(loaded, test, names, "id")


FITTED_SQL = """SELECT doc_id AS id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight
           FROM (SELECT tf.doc_id, tf.term, (1 + ln(tf.tf)) * (ln(CAST(1 + nd.n AS DOUBLE) / (1 + v.df)) + 1) AS w
                 FROM tf JOIN v ON tf.term = v.term, nd) x"""

FITTED_CTES = (
    ("toks", f"SELECT doc_id, {tokens_sql('text', 'train')} AS t FROM documents"),
    ("lem", """SELECT doc_id, CASE WHEN length(x) > 3 AND suffix(x, 's') THEN left(x, length(x) - 1) ELSE x END AS term
               FROM (SELECT doc_id, unnest(t) AS x FROM toks) u"""),
    ("tf", "SELECT doc_id, term, count(*) AS tf FROM lem GROUP BY ALL"),
    ("nd", "SELECT count(*) AS n FROM documents"),
    ("v", "SELECT term, count(*) AS df FROM tf, nd GROUP BY term, n HAVING count(*) >= 5 AND count(*) <= 0.98 * n"),
)


@register(
    "fitted_tfidf",
    ("J1", "J2", "J3", "J4", "I7"),
    with_fixtures(
        FITTED_SQL,
        ctes=FITTED_CTES,
    ),
)
def q_fitted_tfidf(spark, sf_dir):
    """The canonical training features in relational form, one row per non-zero term.

    The vocabulary has no size limit, so it is a table; the stages of the fitted and saved form are
    ``ml_tfidf_vectors``."""
    tf, vocab, n_docs = _fitted_terms(spark, sf_dir)
    return features.tfidf(tf, vocab, n_docs, "id").select("id", "term", r6("weight").alias("weight"))


def _fitted_terms(spark, sf_dir):
    """Stored term counts and vocabulary of all documents, and their number."""
    from msgtriage.operators.transformers import SuffixLemma, TextTokenizer

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("message"))
    tokens = TextTokenizer(inputCol="message", outputCol="tokens").transform(by_key(docs, "id"))
    lemmas = SuffixLemma(inputCol="tokens", outputCol="lemmas").transform(tokens).select("id", "lemmas")
    tf = materialize(features.term_frequencies(lemmas, "id", "lemmas"), "fitted-tf")
    n_docs = features.n_docs_of(docs)
    vocab = materialize(features.vocabulary(tf, n_docs, vocab_size=None, min_df=5, max_df=0.98), "fitted-tfidf")
    return tf, vocab, n_docs


@register("forest_l1_predictions", ("K3", "J2", "J4"))
def q_forest_l1(spark, sf_dir):
    """Forest on L1-normalised TF-IDF over the base stop list."""
    train, test, labels = _split(spark, sf_dir)
    model, _ = models.fit_multilabel(
        train, labels, "tfidf_l1", "forest",
        clf_params={"num_trees": 40, "max_depth": 8, "max_features": "0.8", "max_samples": 0.8},
    )
    return models.predict_long(model, test, labels, "id")


@register("holdout_report", ("F9", "F10", "F11", "K1"))
def q_holdout_report(spark, sf_dir):
    train, test, labels = _split(spark, sf_dir)
    model, _ = models.fit_multilabel(train, labels, "tfidf", "logistic", clf_params={"C": 0.01})
    return metrics.label_report(models.predict_long(model, test, labels, "id"))


@register("forest_predictions", ("K3", "J5", "J4"))
def q_forest(spark, sf_dir):
    train, test, labels = _split(spark, sf_dir)
    model, _ = models.fit_multilabel(
        train, labels, "hashed_l1", "forest",
        clf_params={"num_trees": 40, "max_depth": 8, "max_features": "0.8", "max_samples": 0.8},
    )
    return models.predict_long(model, test, labels, "id")


@register("union_feature_predictions", ("J7", "J10", "J11", "I11", "K2"))
def q_union(spark, sf_dir):
    train, test, labels = _split(spark, sf_dir)
    model, _ = models.fit_multilabel(
        train, labels, "union", "logistic", clf_params={"C": 0.1},
        feature_params={"size": 100, "min_count": 2, "window": 1, "iter": 5, "partitions": 4},
    )
    return models.predict_long(model, test, labels, "id")


def _single_kind(kind, params, feature_params=None):
    def q(spark, sf_dir):
        train, test, labels = _split(spark, sf_dir)
        model, _ = models.fit_multilabel(train, labels, "tfidf", kind, clf_params=params,
                                         balanced=kind not in ("bagging", "mlp"), feature_params=feature_params)
        return models.predict_long(model, test, labels, "id")

    return q


register("gbt_predictions", ("K4",))(_single_kind("gbt", {"max_iter": 100, "max_depth": 10}, {"vocab_size": None}))
register("svm_predictions", ("K5",))(_single_kind("svm", {"C": 0.01, "max_iter": 1000}))
register("bagging_predictions", ("K6",))(_single_kind("bagging", {"num_trees": 60, "max_depth": 30}))
register("mlp_predictions", ("K8",))(_single_kind("mlp", {"layers": [0, 400, 2], "max_iter": 500}))


@register("cross_val_scores", ("K10", "K11", "H3"))
def q_cross_val(spark, sf_dir):
    train, labels = etl.training_table(spark, sf_dir)
    scores = models.cross_val_scores(
        train, labels, 3, 11, "id", "recall_weighted", clf_kind="logistic", clf_params={"C": 0.01},
        resample={"upsample_targets": ("toxic", "long"), "downsample_target": "related"},
    )
    return spark.createDataFrame(scores, "fold INT, recall_weighted DOUBLE")


@register("grid_search_scores", ("K9", "K11"))
def q_grid_search(spark, sf_dir):
    """Scores of the whole grid; the best candidate, refitted, has its per-label report
    on the held-out rows."""
    train, test, labels = _split(spark, sf_dir)
    scores = models.grid_search(train, labels, models.GRID, 3, 11, "id", "recall_weighted")
    best, model = models.refit_best(train, labels, models.GRID, scores)
    report = metrics.label_report(models.predict_long(model, test, labels, "id"))
    report = report.agg(F.lit(best).alias("candidate"), F.sort_array(F.collect_list(F.struct("*"))).alias("report"))  # a few rows per label
    rows = spark.createDataFrame([(*row, row[0] == best) for row in scores], "candidate INT, params STRING, mean_score DOUBLE, best BOOLEAN")
    return rows.join(F.broadcast(report), "candidate", "left")


@register("grid_search_f1_scores", ("K9", "K11", "K6"))
def q_grid_search_f1(spark, sf_dir):
    """The variant's grid: bagged trees of three sizes, scored by ``f1_weighted``."""
    train, _, labels = _split(spark, sf_dir)
    scores = models.grid_search(train, labels, models.BAGGING_GRID, 3, 11, "id", "f1_weighted", "tfidf_l1")
    return spark.createDataFrame(scores, "candidate INT, params STRING, mean_score DOUBLE")


@register("kfold_report", ("K12", "K2", "F9", "H3"))
def q_kfold_report(spark, sf_dir):
    """Features and models fitted per fold, the held-out rows' report by fold and label."""
    train, labels = etl.training_table(spark, sf_dir)
    return models.kfold_report(train, labels, 3, clf_kind="logistic", clf_params={"C": 0.1})


@register(
    "kfold_supports",
    ("K12", "H3", "K1"),
    with_fixtures(
        """SELECT f.fold, u.label, count(*) AS n, count(*) FILTER (u.y = 1) AS support
           FROM (SELECT id, unnest(['related', 'toxic', 'long', 'multi_line']) AS label, unnest([related, toxic, long, multi_line]) AS y FROM training_fx) u
           JOIN folds f ON f.id = u.id GROUP BY ALL""",
        "training_fx",
        ctes=(
            ("ids", "SELECT id FROM training_fx"),
            ("idx", _idx_sql(FOLD_SEED, "ids")),
            ("cnt", "SELECT count(*) AS n FROM idx"),
            ("folds", f"SELECT i.id, {_FOLD_SQL} AS fold FROM idx i, cnt c"),
        ),
    ),
)
def q_kfold_supports(spark, sf_dir):
    """Rows and positive rows that the fitted folds were scored on."""
    train, labels = etl.training_table(spark, sf_dir)
    report = models.kfold_report(train, labels, 3, clf_kind="logistic", clf_params={"C": 0.1})
    return report.select("fold", "label", "n", "support")


@register("stacked_predictions", ("K7",))
def q_stacked(spark, sf_dir):
    train, test, labels = _split(spark, sf_dir)
    return models.stacked_predictions(train, test, labels, 3, 11, "id")


@register("training_timings", ("K14",))
def q_timings(spark, sf_dir):
    train, _, labels = _split(spark, sf_dir)
    _, timings = models.fit_multilabel(train, labels, "tfidf", "logistic", clf_params={"C": 0.01})
    return models.timings_frame(spark, timings)


@register("classified_messages", ("K13", "I16"))
def q_classified(spark, sf_dir):
    """Classify every conversation turn with a model trained on the labelled rows."""
    train, labels = etl.training_table(spark, sf_dir)
    model, _ = models.fit_multilabel(train, labels, "tfidf", "logistic", clf_params={"C": 0.01})
    conv = table(spark, sf_dir, "conversations").select(
        F.concat_ws(":", "conv_id", "turn").alias("id"), F.col("text").alias("message")
    )
    out = models.classify(model, conv, labels, "id")
    return out.select("id", F.array_join("categories", ", ").alias("categories"))


@register("pca_projection", ("J13", "J12"))
def q_pca(spark, sf_dir):
    """The first five principal components of the 200-bucket hashed features of the training rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from msgtriage.operators.features import optional_transform_stage
    from msgtriage.operators.transformers import Dense

    train, labels = etl.training_table(spark, sf_dir)
    # Spark's PCA builds a d x d Gramian: project the 200-bucket hashed
    # features (J5), not the 2,500-term TF-IDF (that is ``svd_projection``).
    fmodel = models.featurizer("hashed_l1", "message").fit(train)
    feats = fmodel.transform(train)
    pipe = Pipeline(stages=[
        Dense(inputCol="features", outputCol="dense"),
        optional_transform_stage("pca", "dense", "pca", k=5),
    ]).fit(feats)
    parts = pipe.transform(feats).select("id", vector_to_array("pca").alias("p"))
    return parts.select("id", F.size("p").alias("k"), *[r6(F.col("p")[i]).alias(f"c{i}") for i in range(5)])


@register("svd_projection", ("J13", "J3"))
def q_svd(spark, sf_dir):
    """Truncated SVD of all documents' sublinear TF-IDF over an unlimited vocabulary: each
    document's place along the five largest right vectors, and the singular values."""
    from msgtriage.operators.svd import truncated_svd

    matrix = _fitted_rows(*_fitted_terms(spark, sf_dir))
    svd = truncated_svd(matrix, 5)
    found = svd.project_rows(matrix)
    sigma = [F.lit(round(x, 6)).alias(f"sigma{i}") for i, x in enumerate(svd.singular_values)]
    return found.select("id", *[r6(F.col("vector")[i]).alias(f"c{i}") for i in range(len(sigma))], *sigma)


def _fitted_rows(tf, vocab, n_docs):
    """The weights of ``fitted_tfidf`` as rows of a matrix, in millionths (they have six decimals).
    Only numbers move, those of a document together."""
    from msgtriage.operators.svd import TermRows
    from msgtriage.session import discard

    raw = features.tfidf(tf, vocab, n_docs, "id", norm=None)
    rows = raw.groupBy("id").agg(F.collect_list("term_index").alias("terms"), F.collect_list("weight").alias("w"), F.sum(F.col("weight") * F.col("weight")).alias("s"))
    whole = F.transform("w", lambda w: F.round(F.round(w / F.sqrt("s"), 6) * 1e6).cast("int"))
    stored = materialize(rows.select("id", "terms", whole.alias("weights")), "fitted-rows")
    discard(tf.sparkSession, tf)
    return TermRows(stored, vocab.select("term", F.col("term_index").alias("index")), vocab.count(), "id", 1e6)


def _first_component_sql():
    return with_fixtures(
        """SELECT d.doc_id, round(coalesce(c.v, (SELECT avg(v) FROM c)), 6) AS first_component
           FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id""",
        ctes=(
            ("toks", f"SELECT doc_id, {tokens_sql('text', 'train')} AS t FROM documents"),
            ("wc", "SELECT w AS word, count(*) AS n FROM (SELECT unnest(t) AS w FROM toks) x GROUP BY w"),
            ("vecs", """SELECT v.word, CAST(e.embedding[1] AS DOUBLE) AS x FROM (SELECT word FROM wc WHERE n >= 5) v
                        JOIN embeddings e ON e.vec_id = CAST(('0x' || substr(md5(v.word), 1, 6)) AS BIGINT) % (SELECT count(*) FROM embeddings)"""),
            ("c", """SELECT doc_id, avg(x) AS v FROM (SELECT doc_id, unnest(t) AS word FROM toks) u
                     JOIN vecs ON u.word = vecs.word GROUP BY doc_id"""),
        ),
    )


@register("imputed_first_component", ("F14",), _first_component_sql())
def q_imputed(spark, sf_dir):
    """Mean vectors' first component (NaN without vocabulary words), imputed with the mean."""
    from pyspark.ml.feature import Imputer

    from msgtriage.plans.queries_vectors import DIM, _doc_tokens, _word_vectors
    from msgtriage.operators import vectors

    toks = _doc_tokens(spark, sf_dir)
    mv = vectors.mean_vectors(toks, _word_vectors(spark, sf_dir, toks), DIM, "doc_id", "tokens")
    # read by the fit and by the fill
    first = materialize(mv.select("doc_id", F.col("meanvec")[0].alias("first_component")), "first-components")
    imp = Imputer(inputCols=["first_component"], outputCols=["first_component"], strategy="mean")
    out = imp.fit(first).transform(first)
    return out.select("doc_id", r6("first_component").alias("first_component"))


@register("training_run_report", ("H2", "H4", "H5", "D3", "K1", "K2", "F9", "F11", "A8"))
def q_training_run(spark, sf_dir):
    """The canonical run: hold-out split, rare labels upsampled in sequence, the
    most common label's negatives resampled, fit, save, per-label report."""
    from msgtriage.plans.training import train_and_evaluate

    data, labels = etl.training_table(spark, sf_dir)
    report, _ = train_and_evaluate(
        spark, data, labels, upsample_targets=("toxic", "long"), downsample_target="related",
        model_path=scratch_path(spark, "trained-model"),
    )
    return report
