import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from msgtriage.operators import models
from msgtriage.plans.queries_ml import _split
from msgtriage.session import scratch_path
from msgtriage.sources.models import load_model, save_model
from msgtriage.streaming import jobs


def test_save_load_and_stream_equal_batch(spark):
    train, test, labels = _split(spark, SF_SMALL)
    model, timings = models.fit_multilabel(
        train, labels, "tfidf", "logistic", clf_params={"C": 0.01}, feature_params={"min_df": 1.0}
    )
    assert {"featurize_fit", "classifiers_fit"} <= set(timings)
    batch = models.predict_long(model, test, labels, "id", with_truth=False)

    path = scratch_path(spark, "model-test")
    save_model(model, path, labels)
    loaded, names = load_model(spark, path)
    assert names == labels
    again = models.predict_long(loaded, test, names, "id", with_truth=False)
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, again.collect()))

    base = scratch_path(spark, "stream-test")
    landing, sink, ckpt = (os.path.join(base, p) for p in ("in", "out", "ck"))
    incoming = test.select("id", "message")
    jobs.land_files(incoming, landing, 3)
    jobs.run(jobs.score_stream(spark, loaded, names, landing, incoming.schema, sink, ckpt, "id"))
    streamed = spark.read.parquet(sink).select("id", "label", "yhat")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_classify_names_labels(spark):
    train, test, labels = _split(spark, SF_SMALL)
    model, _ = models.fit_multilabel(train, labels, clf_params={"C": 0.01}, feature_params={"min_df": 1.0})
    out = models.classify(model, test, labels, "id").collect()
    allowed = {x.replace("_", " ").title() for x in labels}
    assert out and all(set(r.categories) <= allowed for r in out)


def test_stream_dedupe_modes_agree(spark):
    from msgtriage.plans.fixtures import messages_fx

    msgs = messages_fx(spark, SF_SMALL)
    expected = sorted(map(tuple, msgs.select("id", "genre").distinct().collect()))
    for mode in ("state", "anti_join"):
        base = scratch_path(spark, f"dedupe-{mode}")
        landing, sink, ckpt = (os.path.join(base, p) for p in ("in", "out", "ck"))
        jobs.land_files(msgs, landing, 3)
        jobs.run(jobs.dedupe_stream(spark, landing, msgs.schema, sink, ckpt, "id", mode=mode))
        got = sorted(map(tuple, spark.read.parquet(sink).select("id", "genre").collect()))
        assert got == expected, mode


def test_grid_is_whole_and_best_is_refitted(spark):
    kinds = [c["clf_kind"] for c in models.GRID]
    assert kinds.count("forest") == 16 and kinds.count("logistic") == 2
    train, test, labels = _split(spark, SF_SMALL)
    scores = [(i, "", 0.5 + (i in (16, 17))) for i in range(18)]
    best, model = models.refit_best(train, labels, models.GRID, scores)
    assert best == 16  # the first of equal ones
    assert models.predict_long(model, test, labels, "id").count() == test.count() * len(labels)


def test_resampling_stays_inside_training_folds(spark):
    train, _, labels = _split(spark, SF_SMALL)
    plain = {f: (n, te.count()) for f, _, te, n in models._fold_features(train, labels, 3, 11, "id")}
    resample = {"upsample_targets": ("toxic",)}
    for fold, tr, te, n in models._fold_features(train, labels, 3, 11, "id", resample=resample):
        assert te.count() == plain[fold][1] and n > plain[fold][0]
        assert tr.join(te, "id", "left_semi").isEmpty()


def test_wide_tree_fits_run_one_at_a_time(spark):
    from pyspark.ml.linalg import Vectors

    feats = spark.createDataFrame([(Vectors.sparse(1 << 20, [1], [1.0]),)], ["features"])
    assert [models.fits_at_once(k, feats, 10_000, 4) for k in ("logistic", "forest", "gbt")] == [4, 1, 1]
    assert models.fits_at_once("forest", feats, 100, 4) == 2 and models.fits_at_once("forest", feats.limit(0), 9, 4) == 4
