"""One classifier per label with Spark ML.

Featurisation is fitted once and its output persisted; each label's model is
then fitted as its own set of Spark jobs, several labels at a time from a
driver thread pool (the jobs themselves run on the executors). The result is
a single ``PipelineModel`` (featuriser stages + one classifier per label,
predicting into ``pred_<label>``), saved and loaded with the label list (A8).
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgtriage.functions.text import display_name
from msgtriage.operators import features as feat
from msgtriage.operators.metrics import label_report, multilabel_scores
from msgtriage.operators.sampling import assign_folds, resample_training
from msgtriage.operators.table_models import PopulationScaler, SentenceVector
from msgtriage.operators.transformers import KeywordSearch, SuffixLemma, TextTokenizer

# --------------------------------------------------------------------------
# Estimators (K2-K8)
# --------------------------------------------------------------------------


def make_classifier(
    kind: str, label: str, n_rows: int, features_col: str = "features",
    weight_col: str | None = None, seed: int = 11, **p,
):
    """A binary classifier for ``label`` writing ``pred_<label>``.

    kinds: ``logistic`` (C: sklearn's inverse strength, mapped to
    ``regParam = 1 / (C * n)``), ``forest``, ``bagging`` (forest over all
    features), ``extra_trees`` (forest approximation, documented), ``gbt``,
    ``svm``, ``mlp``.
    """
    from pyspark.ml import classification as C

    common = dict(featuresCol=features_col, labelCol=label, predictionCol=f"pred_{label}")
    if kind == "logistic":
        c = float(p.get("C", 0.01))
        m = C.LogisticRegression(
            **common, rawPredictionCol=f"raw_{label}", probabilityCol=f"prob_{label}",
            regParam=1.0 / (c * max(n_rows, 1)), elasticNetParam=0.0, standardization=False,
            maxIter=int(p.get("max_iter", 50)), family="binomial",
        )
    elif kind in ("forest", "bagging", "extra_trees"):
        if int(p.get("max_depth", 8)) > 30:
            raise ValueError("trees of Spark ML are at most 30 levels deep")
        m = C.RandomForestClassifier(
            **common, rawPredictionCol=f"raw_{label}", probabilityCol=f"prob_{label}",
            numTrees=int(p.get("num_trees", 40)), maxDepth=int(p.get("max_depth", 8)),
            featureSubsetStrategy="all" if kind == "bagging" else str(p.get("max_features", "sqrt")),
            subsamplingRate=float(p.get("max_samples", 1.0)), seed=seed,
        )
    elif kind == "gbt":
        m = C.GBTClassifier(
            **common, maxIter=int(p.get("max_iter", 100)), stepSize=float(p.get("step", 0.05)),
            subsamplingRate=float(p.get("subsample", 0.8)),
            featureSubsetStrategy=str(p.get("feature_fraction", "0.8")), seed=seed,
            maxDepth=int(p.get("max_depth", 5)),
        )
        m._set(rawPredictionCol=f"raw_{label}", probabilityCol=f"prob_{label}")
    elif kind == "svm":
        m = C.LinearSVC(
            **common, rawPredictionCol=f"raw_{label}", standardization="C" not in p,
            regParam=1.0 / (float(p["C"]) * max(n_rows, 1)) if "C" in p else float(p.get("reg", 0.01)),
            maxIter=int(p.get("max_iter", 50)),
        )
    elif kind == "mlp":
        m = C.MultilayerPerceptronClassifier(
            **common, rawPredictionCol=f"raw_{label}", probabilityCol=f"prob_{label}",
            layers=list(p["layers"]), maxIter=int(p.get("max_iter", 50)), seed=seed,
        )
    else:
        raise ValueError(kind)
    if weight_col is not None and m.hasParam("weightCol"):
        m = m.setWeightCol(weight_col)
    return m


# --------------------------------------------------------------------------
# Featurisers
# --------------------------------------------------------------------------


def featurizer(
    kind: str = "tfidf", text_col: str = "message", variant: str = "train", **p
) -> Pipeline:
    """Feature families, ending in one ``features`` vector.

    ``tfidf``: tokens -> lemmas -> counts (2500, min_df 5, max_df .98) -> sublinear TF ->
    IDF + 1 -> L2, the reference's weights, sparse throughout.
    Without a vocabulary size every term within the bounds is kept: by ``tfidf`` as a table of any
    size, by the other kinds, whose ``min_df`` is a share of the rows, up to ``features.ML_TERMS``
    terms, beyond which they raise an error.
    ``tfidf_l1``: tokens (base stop list) -> counts (min_df .01, max_df .95) -> IDF -> L1.
    ``hashed_l1``: tokens -> HashingTF -> IDF -> L1.
    ``union``: TF-IDF + standardised sentence vectors (J9, J10) + keyword flags, and the outputs
    of ``families``, further stages over ``tokens`` such as fitted lexicon models.
    """
    tok = TextTokenizer(inputCol=text_col, outputCol="tokens", variant=variant)
    if kind == "tfidf":
        vocab_size = p.get("vocab_size", 2500)
        stages = feat.tfidf_stages(
            "lemmas", "features", vocab_size, float(p.get("min_df", 5.0)),
            float(p.get("max_df", 0.98)), 2.0, True, tables=vocab_size is None,
        )
        return Pipeline(stages=[tok, SuffixLemma(inputCol="tokens", outputCol="lemmas"), *stages])
    if kind == "tfidf_l1":
        tok = TextTokenizer(inputCol=text_col, outputCol="tokens", variant="base")
        stages = feat.tfidf_stages(
            "tokens", "features", p.get("vocab_size"), float(p.get("min_df", 0.01)),
            float(p.get("max_df", 0.95)), 1.0,
        )
        return Pipeline(stages=[tok, *stages])
    if kind == "hashed_l1":
        from pyspark.ml.feature import IDF, Normalizer

        return Pipeline(stages=[
            tok, feat.hashing_stage("tokens", "hashed", int(p.get("num_features", 200))),
            IDF(inputCol="hashed", outputCol="hashed_idf"),
            Normalizer(inputCol="hashed_idf", outputCol="features", p=1.0),
        ])
    if kind == "union":
        from pyspark.ml.feature import VectorSizeHint

        stages = feat.tfidf_stages(
            "tokens", "tfidf", p.get("vocab_size"), float(p.get("min_df", 0.01)),
            float(p.get("max_df", 0.95)), 2.0,
        )
        sentence = SentenceVector(
            inputCol="tokens", outputCol="sentvec", vectorSize=int(p.get("size", 100)),
            minCount=int(p.get("min_count", 2)), windowSize=int(p.get("window", 1)),
            maxIter=int(p.get("iter", 5)), numPartitions=int(p.get("partitions", 1)),
        )
        scale = PopulationScaler(inputCol="sentvec", outputCol="sentvec_std")
        kw = KeywordSearch(inputCol="tokens", outputCol="keywords")
        hint = VectorSizeHint(inputCol="keywords", size=len(kw.getOrDefault(kw.keywords)))
        families = list(p.get("families", ()))
        union = feat.assemble_stage(["tfidf", "sentvec_std", "keywords", *[f.getOutputCol() for f in families]], "features")
        return Pipeline(stages=[tok, *stages, sentence, scale, kw, hint, *families, union])
    raise ValueError(kind)


# --------------------------------------------------------------------------
# K1 multi-label fit
# --------------------------------------------------------------------------


ROWS_PER_PARTITION = 20_000


def right_size(df: DataFrame, n_rows: int, rows_per_partition: int = ROWS_PER_PARTITION):
    """Partitions of about ``rows_per_partition`` rows for the iterative fits: each
    optimizer iteration is a job over every partition, so tiny partitions cost more in
    task overhead than they save. The rows move after featurising, which keeps the
    parallelism of its input."""
    return df.repartition(partitions_for(n_rows, rows_per_partition))


def partitions_for(n_rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    return max(1, math.ceil(n_rows / rows_per_partition))


_TREES = ("forest", "bagging", "extra_trees", "gbt")
TREE_ROWS_BYTES = 1 << 30


def fits_at_once(kind: str, feats: DataFrame, n_rows: int, parallelism: int) -> int:
    """Fits that may run side by side. A tree learner keeps every row as one int per feature while
    it fits, however sparse the vectors are: together they keep about ``TREE_ROWS_BYTES``, at least one
    fit runs. The number changes no model."""
    row = feats.select("features").first() if kind in _TREES else None
    if row is None or row["features"] is None:
        return parallelism
    return max(1, min(parallelism, TREE_ROWS_BYTES // max(4 * n_rows * row["features"].size, 1)))


def balanced_weight_columns(feats: DataFrame, labels: Sequence[str]) -> dict:
    """F12 for every label in one pass: ``n / (k * n_c)`` over the 0/1 rows,
    returned as a literal CASE expression per label (no join per fit)."""
    aggs = []
    for x in labels:
        aggs += [F.count_if(F.col(x) == 0).alias(f"{x}__0"), F.count_if(F.col(x) == 1).alias(f"{x}__1")]
    row = feats.agg(*aggs).first()
    out = {}
    for x in labels:
        present = [(c, row[f"{x}__{c}"]) for c in (0, 1) if row[f"{x}__{c}"] > 0]
        n = sum(nc for _, nc in present)
        expr = None
        for c, nc in present:
            w = F.lit(n / (len(present) * nc))
            expr = F.when(F.col(x) == c, w) if expr is None else expr.when(F.col(x) == c, w)
        out[x] = expr if expr is not None else F.lit(1.0)
    return out


def fit_classifiers(
    feats: DataFrame,
    labels: Sequence[str],
    clf_kind: str = "logistic",
    balanced: bool = True,
    parallelism: int = 4,
    clf_params: dict | None = None,
    n_rows: int | None = None,
    weights: dict | None = None,
) -> tuple[dict, dict[str, float]]:
    """One classifier per label on an already featurised (and persisted)
    ``features`` column, several labels at a time from a thread pool. ``weights``: the
    columns of ``balanced_weight_columns``, where they are known already."""
    n_rows = n_rows if n_rows is not None else feats.count()
    clf_params = dict(clf_params or {})
    if clf_kind == "mlp":  # the input layer is the feature width
        width = feats.select("features").first()["features"].size
        clf_params["layers"] = [width, *list(clf_params.get("layers", [0, 16, 2]))[1:]]

    weights = (weights or balanced_weight_columns(feats, labels)) if balanced else {}

    def fit_one(label: str):
        start = time.perf_counter()
        data = feats.where(F.col(label).isin(0, 1))
        wcol = None
        if balanced:
            wcol = f"w_{label}"
            data = data.withColumn(wcol, weights[label])
        data = data.withColumn(label, F.col(label).cast("double"))
        clf = make_classifier(clf_kind, label, n_rows, "features", wcol, **clf_params)
        model = clf.fit(data)
        return label, model, time.perf_counter() - start

    with ThreadPoolExecutor(max_workers=fits_at_once(clf_kind, feats, n_rows, max(1, parallelism))) as pool:
        results = list(pool.map(inheritable_thread_target(fit_one), list(labels)))
    return {label: m for label, m, _ in results}, {f"fit_{label}": t for label, _, t in results}


def fit_multilabel(
    df: DataFrame,
    labels: Sequence[str],
    feature_kind: str = "tfidf",
    clf_kind: str = "logistic",
    balanced: bool = True,
    parallelism: int = 4,
    text_col: str = "message",
    feature_params: dict | None = None,
    clf_params: dict | None = None,
) -> tuple[PipelineModel, dict[str, float]]:
    """K1 (+ K14): fit the featuriser, then one classifier per label in parallel.

    Returns the combined ``PipelineModel`` and wall-clock seconds per step.
    """
    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    stages = featurizer(feature_kind, text_col, **(feature_params or {})).getStages()
    # Tokenise once: the vectorizer fit, the IDF fit and the feature table all
    # read this narrow persisted frame instead of re-running the text plan.
    tok = stages[0]
    tokd = tok.transform(df).select("tokens", *labels).persist(StorageLevel.MEMORY_AND_DISK)
    n_rows = tokd.count()
    rest = Pipeline(stages=stages[1:]).fit(tokd)
    timings["featurize_fit"] = time.perf_counter() - t0

    t0 = time.perf_counter()
    feats = right_size(rest.transform(tokd).select("features", *labels), n_rows)
    feats = feats.persist(StorageLevel.MEMORY_AND_DISK)
    feats.count()
    tokd.unpersist()
    timings["featurize_transform"] = time.perf_counter() - t0
    fmodel_stages = [tok, *rest.stages]

    t0 = time.perf_counter()
    by_label, fit_times = fit_classifiers(
        feats, labels, clf_kind, balanced, parallelism, clf_params, n_rows
    )
    timings["classifiers_fit"] = time.perf_counter() - t0
    timings.update(fit_times)
    feats.unpersist()
    return PipelineModel(stages=[*fmodel_stages, *[by_label[x] for x in labels]]), timings


def timings_frame(spark, timings: dict[str, float]) -> DataFrame:
    """``(step, seconds)``."""
    return spark.createDataFrame([(k, float(v)) for k, v in timings.items()], "step STRING, seconds DOUBLE")


# --------------------------------------------------------------------------
# Prediction
# --------------------------------------------------------------------------


def predict_long(
    model: PipelineModel, df: DataFrame, labels: Sequence[str], key: str = "id",
    with_truth: bool = True,
) -> DataFrame:
    """``(key, label, [y,] yhat)`` long predictions; names travel with values (Q7)."""
    out = model.transform(df)
    return _long(out, labels, key, with_truth)


def _long(scored: DataFrame, labels: Sequence[str], key: str, with_truth: bool = True) -> DataFrame:
    """One row per (input row, label); truth and prediction come from the same row."""
    fields = [
        F.struct(
            F.lit(x).alias("label"), *([F.col(x).cast("int").alias("y")] if with_truth else []),
            F.col(f"pred_{x}").cast("int").alias("yhat"),
        )
        for x in labels
    ]
    return scored.select(key, F.explode(F.array(*fields)).alias("_p")).select(key, "_p.*")


def classify(model: PipelineModel, df: DataFrame, labels: Sequence[str], key: str = "id"):
    """``(key, categories)``: display names of the predicted labels."""
    out = model.transform(df)
    pairs = F.array(
        *[F.struct(F.lit(x).alias("name"), F.col(f"pred_{x}").alias("p")) for x in labels]
    )
    hits = F.filter(pairs, lambda s: s["p"] == 1.0)
    return out.select(key, F.transform(hits, lambda s: display_name(s["name"])).alias("categories"))


# --------------------------------------------------------------------------
# K9 / K10 cross-validation, K7 stacking
# --------------------------------------------------------------------------


def _fold_features(df, labels, k, seed, key, feature_kind="tfidf", feature_params=None, resample=None):
    """Per fold: the featuriser fitted on the other folds, applied to both
    parts; persisted, right-sized. Folds are assigned on the key first (Q20);
    ``resample`` (arguments of ``resample_training``) then changes the training part only.

    Tokenising is stateless, so the folded rows are tokenised once into a
    narrow persisted frame; only the vectorizer / IDF are fitted per fold.
    """
    stages = featurizer(feature_kind, **(feature_params or {})).getStages()
    tok, rest_stages = stages[0], stages[1:]
    folded = assign_folds(df, k, key, seed)
    tokd = tok.transform(folded).select(key, "fold", "tokens", *labels)
    tokd = tokd.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for fold in range(k):
            train = tokd.where(F.col("fold") != fold)
            test = tokd.where(F.col("fold") == fold)
            if resample:
                train = resample_training(train, key=key, seed=seed, **resample)
            rest = Pipeline(stages=rest_stages).fit(train)
            tr = rest.transform(train).select(key, "features", *labels)
            n = tr.count()
            tr = right_size(tr, n).persist(StorageLevel.MEMORY_AND_DISK)
            te = rest.transform(test).select(key, "features", *labels)
            te = te.persist(StorageLevel.MEMORY_AND_DISK)
            yield fold, tr, te, n
            tr.unpersist()
            te.unpersist()
    finally:
        tokd.unpersist()


def _predict_features(by_label: dict, feats: DataFrame, labels: Sequence[str], key: str):
    """Long ``(key, label, y, yhat)`` from per-label models over a features table."""
    out = feats
    for x in labels:
        out = by_label[x].transform(out).drop(f"raw_{x}", f"prob_{x}")
    return _long(out, labels, key)


def _pooled(tasks: Sequence, parallelism: int) -> list:
    """Results of the calls, several at a time; their jobs share the cluster (in FAIR pools of
    their own where the session schedules so)."""

    def run(numbered):
        i, task = numbered
        SparkSession.active().sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{i % max(1, parallelism)}")
        return task()

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(inheritable_thread_target(run), list(enumerate(tasks))))


_FORESTS = ("forest", "bagging")


def first_trees(model, n_trees: int):
    """The forest of the first ``n_trees`` trees of a fitted forest. Trees of a forest are drawn
    independently of each other, so this is a fit with that number of trees."""
    from pyspark.ml.classification import RandomForestClassificationModel

    if n_trees == len(model._java_obj.trees()):
        return model
    jvm, gateway = model._java_obj, SparkSession.active().sparkContext._gateway
    trees = jvm.trees()
    kept = gateway.new_array(gateway.jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel, n_trees)
    for i in range(n_trees):
        kept[i] = trees[i]
    forest = gateway.jvm.org.apache.spark.ml.classification.RandomForestClassificationModel
    part = RandomForestClassificationModel(forest(f"{model.uid}_{n_trees}", kept, model.numFeatures, model.numClasses))
    for col in ("features", "prediction", "rawPrediction", "probability"):
        part._set(**{f"{col}Col": model.getOrDefault(f"{col}Col")})
    part._java_obj.set(part._java_obj.getParam("numTrees"), n_trees)
    return part


def _fits(candidates: Sequence[dict]) -> list[tuple[dict, list[int]]]:
    """The fits that all candidates need: those that differ in the number of trees only share the
    largest forest."""
    groups: dict[str, list[int]] = {}
    for i, cand in enumerate(candidates):
        params = dict(cand.get("clf_params") or {})
        if cand.get("clf_kind") in _FORESTS:
            params.pop("num_trees", None)
        groups.setdefault(json.dumps({**cand, "clf_params": params}, sort_keys=True), []).append(i)
    trees = lambda i: (candidates[i].get("clf_params") or {}).get("num_trees", 0)
    return [(candidates[max(own, key=trees)], own) for own in groups.values()]


def grid_search(
    df: DataFrame, labels: Sequence[str], candidates: Sequence[dict], k: int = 3, seed: int = 11,
    key: str = "id", scorer: str = "recall_weighted", feature_kind: str = "tfidf",
    parallelism: int = 8,
) -> list[tuple[int, str, float]]:
    """K9: mean cross-validated score per candidate ``{clf_kind, clf_params, balanced}``.

    Each fold is featurised once (fitted on that fold's training part). Forests that differ in
    their number of trees only are fitted once, with most trees, and scored at each number; the
    fits of all (candidate, label) of a fold wait in one pool, and so do the candidates' scores.
    """
    scores: dict[int, list[float]] = {i: [] for i in range(len(candidates))}
    fits = _fits(candidates)
    for _fold, tr, te, n in _fold_features(df, labels, k, seed, key, feature_kind):
        weights = balanced_weight_columns(tr, labels)

        def fit(cand, label):
            one = {label: weights[label]} if cand.get("balanced", True) else None
            by, _ = fit_classifiers(tr, [label], cand.get("clf_kind", "logistic"), one is not None, 1, cand.get("clf_params"), n, one)
            return by[label]

        wanted = [(g, x) for g in range(len(fits)) for x in labels]
        at_once = min(fits_at_once(c.get("clf_kind", "logistic"), tr, n, parallelism) for c, _ in fits)
        fitted = dict(zip(wanted, _pooled([lambda g=g, x=x: fit(fits[g][0], x) for g, x in wanted], at_once)))

        def score(g, i):
            params = candidates[i].get("clf_params") or {}
            cut = (lambda m: first_trees(m, int(params["num_trees"]))) if candidates[i].get("clf_kind") in _FORESTS and "num_trees" in params else (lambda m: m)
            by_label = {x: cut(fitted[g, x]) for x in labels}
            return i, float(multilabel_scores(_predict_features(by_label, te, labels, key)).first()[scorer])

        for i, value in _pooled([lambda g=g, i=i: score(g, i) for g, (_, own) in enumerate(fits) for i in own], parallelism):
            scores[i].append(value)
    return [
        (i, json.dumps(c, sort_keys=True), sum(scores[i]) / len(scores[i]))
        for i, c in enumerate(candidates)
    ]


#: The reference's grid: 16 forests and 2 logistic models.
GRID: tuple[dict, ...] = (
    *(
        {"clf_kind": "forest", "balanced": False,
         "clf_params": {"num_trees": trees, "max_depth": depth, "max_samples": rows, "max_features": str(terms)}}
        for trees in (20, 50) for depth in (4, 8) for rows in (0.6, 0.8) for terms in (0.6, 0.8)
    ),
    *({"clf_kind": "logistic", "balanced": True, "clf_params": {"C": c}} for c in (0.1, 0.01)),
)


#: The variant's grid: bagged trees, three numbers of them.
BAGGING_GRID: tuple[dict, ...] = tuple(
    {"clf_kind": "bagging", "balanced": False, "clf_params": {"num_trees": trees, "max_depth": 8}} for trees in (100, 110, 120)
)


def refit_best(
    train: DataFrame, labels: Sequence[str], candidates: Sequence[dict],
    scores: Sequence[tuple[int, str, float]], feature_kind: str = "tfidf",
) -> tuple[int, PipelineModel]:
    """K9: the first candidate of the highest mean score, fitted on all training rows."""
    best = max(scores, key=lambda row: (row[2], -row[0]))[0]
    cand = candidates[best]
    model, _ = fit_multilabel(
        train, labels, feature_kind, cand.get("clf_kind", "logistic"), cand.get("balanced", True),
        clf_params=cand.get("clf_params"),
    )
    return best, model


def stored_folds(
    df: DataFrame, labels: Sequence[str], k: int = 3, seed: int = 11, key: str = "id",
    feature_kind: str = "tfidf", feature_params: dict | None = None, resample: dict | None = None,
) -> tuple[DataFrame, dict[int, int]]:
    """All folds featurised, as one stored table ``fold, part, key, features, labels`` (``part``
    is ``train`` or ``test``; every row occurs once per fold), and the training rows of each fold."""
    from msgtriage.session import materialize

    stored, sizes = None, {}
    for fold, tr, te, n in _fold_features(df, labels, k, seed, key, feature_kind, feature_params, resample):
        both = [p.select(F.lit(fold).alias("fold"), F.lit(name).alias("part"), key, "features", *labels) for p, name in ((tr, "train"), (te, "test"))]
        one = materialize(both[0].unionByName(both[1]), f"fold-{fold}")  # read while the fold's rows are cached
        stored = one if stored is None else stored.unionByName(one)
        sizes[fold] = n
    return stored, sizes


def fold_predictions(
    df: DataFrame, labels: Sequence[str], k: int = 3, seed: int = 11, key: str = "id",
    clf_kind: str = "logistic", clf_params: dict | None = None, balanced: bool = True,
    feature_kind: str = "tfidf", feature_params: dict | None = None, resample: dict | None = None,
    parallelism: int = 8,
) -> DataFrame:
    """Held-out predictions ``fold, key, label, y, yhat`` of every row, each by the models of
    the fold that did not see it. The fits of all (fold, label) wait in one pool and read one
    stored table of features."""
    stored, sizes = stored_folds(df, labels, k, seed, key, feature_kind, feature_params, resample)
    parts = {f: [stored.where((F.col("fold") == f) & (F.col("part") == p)) for p in ("train", "test")] for f in sizes}
    # the stored rows are right-sized: the fits of all labels read them in place, none moves them again
    parts = {f: [train.coalesce(partitions_for(sizes[f])), test] for f, (train, test) in parts.items()}
    weights = {f: balanced_weight_columns(parts[f][0], labels) for f in sizes} if balanced else {}

    def fit(fold, label):
        own = {label: weights[fold][label]} if balanced else None
        by, _ = fit_classifiers(parts[fold][0], [label], clf_kind, balanced, 1, clf_params, sizes[fold], own)
        return by[label]

    wanted = [(f, x) for f in sizes for x in labels]
    fitted = dict(zip(wanted, _pooled([lambda f=f, x=x: fit(f, x) for f, x in wanted], parallelism)))
    out = None
    for f in sizes:
        scored = _predict_features({x: fitted[f, x] for x in labels}, parts[f][1], labels, key)
        scored = scored.select(F.lit(f).alias("fold"), key, "label", "y", "yhat")
        out = scored if out is None else out.unionByName(scored)
    return out


def kfold_report(df: DataFrame, labels: Sequence[str], k: int = 3, **settings) -> DataFrame:
    """The per-label report (F9) of each fold's held-out rows, by ``fold, label``, with
    ``n`` rows and ``support`` positive ones, in one aggregate over ``fold_predictions``."""
    from msgtriage.session import materialize

    scored = materialize(fold_predictions(df, labels, k, **settings), "fold-predictions")
    sizes = scored.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("support"))
    return label_report(scored, ("fold", "label")).join(sizes, ["fold", "label"])


def cross_val_scores(
    df: DataFrame, labels: Sequence[str], k: int = 3, seed: int = 11, key: str = "id",
    scorer: str = "recall_weighted", clf_kind: str = "logistic", clf_params: dict | None = None,
    balanced: bool = True, feature_kind: str = "tfidf", resample: dict | None = None,
) -> list[tuple[int, float]]:
    """Per fold, fit on the other folds and score the held-out fold.

    Folds are assigned on the original key first (Q20); ``resample`` happens
    inside the training part of each fold.
    """
    out = []
    for fold, tr, te, n in _fold_features(df, labels, k, seed, key, feature_kind, None, resample):
        by_label, _ = fit_classifiers(tr, labels, clf_kind, balanced, 4, clf_params, n)
        row = multilabel_scores(_predict_features(by_label, te, labels, key)).first()
        out.append((fold, float(row[scorer])))
    return out


def stacked_predictions(
    df: DataFrame, test: DataFrame, labels: Sequence[str], k: int = 3, seed: int = 11,
    key: str = "id", base: Sequence[tuple[str, dict]] = (
        ("forest", {"num_trees": 10, "max_depth": 5}), ("logistic", {"C": 0.01})
    ),
    feature_kind: str = "tfidf",
) -> DataFrame:
    """K7: stacking. Base classifiers' out-of-fold predictions (folds by key)
    become the meta features of one logistic model per label.

    The featuriser is fitted once on the training rows and its output
    persisted; every base fit (per fold, per label) reads that table.
    Returns long predictions ``(key, label, y, yhat)`` of the meta model on ``test``.
    """
    from pyspark.ml.feature import VectorAssembler

    fmodel = featurizer(feature_kind).fit(df)
    folded = assign_folds(fmodel.transform(df).select(key, "features", *labels), k, key, seed)
    feats = right_size(folded, folded.count()).persist(StorageLevel.MEMORY_AND_DISK)
    test_feats = fmodel.transform(test).select(key, "features", *labels)
    names = [f"{kind}_{x}" for kind, _ in base for x in labels]

    def base_preds(models_by_label, rows, kind):
        out = rows
        for x in labels:
            out = models_by_label[x].transform(out).withColumnRenamed(f"pred_{x}", f"{kind}_{x}")
            out = out.drop(f"raw_{x}", f"prob_{x}")
        return out

    oof = None
    for fold in range(k):
        train = feats.where(F.col("fold") != fold)
        part = feats.where(F.col("fold") == fold)
        for kind, params in base:
            fitted, _ = fit_classifiers(train, labels, kind, True, 4, params)
            part = base_preds(fitted, part, kind)
        part = part.select(key, *labels, *names)
        oof = part if oof is None else oof.unionByName(part)
    scored_test = test_feats
    for kind, params in base:
        fitted, _ = fit_classifiers(feats, labels, kind, True, 4, params)
        scored_test = base_preds(fitted, scored_test, kind)
    # read by every label's meta prediction below: compute the base chain once
    scored_test = scored_test.select(key, *labels, *names).persist(StorageLevel.MEMORY_AND_DISK)
    assemble = VectorAssembler(inputCols=names, outputCol="meta")
    meta_train = assemble.transform(oof).select(key, "meta", *labels).withColumnRenamed("meta", "features")
    meta_train = meta_train.persist(StorageLevel.MEMORY_AND_DISK)
    meta_test = assemble.transform(scored_test).select(
        key, F.col("meta").alias("features"), *labels
    )
    meta_models, _ = fit_classifiers(meta_train, labels, "logistic", True, 4, {"C": 1.0})
    preds = None
    for x in labels:
        p = meta_models[x].transform(meta_test).select(
            key, F.lit(x).alias("label"), F.col(x).cast("int").alias("y"),
            F.col(f"pred_{x}").cast("int").alias("yhat"),
        )
        preds = p if preds is None else preds.unionByName(p)
    # write the result to the shared folder, then release every cached frame
    from msgtriage.session import materialize

    out = materialize(preds, "stacked-predictions")
    for cached in (feats, scored_test, meta_train):
        cached.unpersist()
    return out
