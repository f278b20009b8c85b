import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from msgtriage.operators import features, lexicon, models, sampling, vectors
from msgtriage.operators.table_models import (
    EntityCount, GetVerbNounCount, PopulationScaler, SentenceVector, SentenceVectorModel, StartingVerbExtractor, phrase_trie, phrase_types,
)
from msgtriage.operators.transformers import SublinearTF
from msgtriage.plans.catalog import REGISTRY
from msgtriage.session import scratch_path


def reload(spark, model):
    path = scratch_path(spark, "table-model")
    model.write().overwrite().save(path)
    return type(model).load(path)


def corpus(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "rare"]
    rows = [(i, [rng.choice(words) for _ in range(rng.randrange(0, 9))]) for i in range(40)]
    rows += [(100, None), (101, []), (7, ["alpha", "beta"]), (7, ["alpha", "beta"]), (None, ["delta"])]
    return rows, spark.createDataFrame(rows, "id long, tokens array<string>").withColumn("_content", F.lit("clash"))


def test_sentence_vector_model_is_the_recurrence(spark):
    rows, df = corpus(spark)
    known = {"alpha": [1.0, 2.0, -1.0], "beta": [0.5, 0.0, 4.0], "gamma": [0.0, 0.0, 0.0], "delta": [3.0, -3.0, 0.25]}
    model = SentenceVectorModel.of(spark.createDataFrame(list(known.items()), "word string, vector array<double>"), 3)

    def recurrence(tokens):
        v = np.zeros(3)
        for t in tokens or []:
            if t in known:
                v = (np.array(known[t]) + v) / 3
        return tuple(np.round(v, 9) + 0.0)

    want = Counter((i, recurrence(t)) for i, t in rows)
    for m in (model, reload(spark, model)):
        out = m.transform(df)
        assert out.columns == ["id", "tokens", "_content", "sentvec"]
        assert Counter((r.id, tuple(np.round(r.sentvec.toArray(), 9) + 0.0)) for r in out.collect()) == want
    table = vectors.sentence_vectors(df.where("id < 40 AND id <> 7").select("id", "tokens"), model.tables["vectors"], 3)
    assert Counter((r.id, tuple(np.round(r.sentvec, 9) + 0.0)) for r in table.collect()) == Counter({k: n for k, n in want.items() if k[0] is not None and k[0] < 40 and k[0] != 7})


def test_population_scaler(spark):
    rows = [(float(i), float(i * i), 5.0) for i in range(7)]
    df = spark.createDataFrame([(Vectors.dense(r),) for r in rows], ["sentvec"])
    model = PopulationScaler(inputCol="sentvec", outputCol="z").fit(df)
    x = np.array(rows)
    sd = x.std(axis=0)
    want = np.where(sd > 0, (x - x.mean(axis=0)) / np.where(sd > 0, sd, 1), 0)
    for m in (model, reload(spark, model)):
        got = np.array([r.z.toArray() for r in m.transform(df).collect()])
        assert np.allclose(got[np.lexsort(got.T)], want[np.lexsort(want.T)])


def test_sublinear_tf_stays_sparse(spark):
    rows = [(1, Vectors.sparse(9, [1, 5], [1.0, 4.0])), (2, Vectors.sparse(9, [], [])), (3, Vectors.dense([0.0, 2.0])), (4, None)]
    df = spark.createDataFrame(rows, ["id", "counts"])
    got = {r.id: r.tf for r in SublinearTF(inputCol="counts", outputCol="tf").transform(df).collect()}
    assert isinstance(got[1], SparseVector) and got[1].indices.tolist() == [1, 5] and np.allclose(got[1].values, [1.0, 1.0 + np.log(4)])
    assert got[2] == Vectors.sparse(9, [], []) and np.allclose(got[3].toArray(), [0.0, 1.0 + np.log(2)]) and got[4] is None


def leftmost_longest(tokens, gazetteer):
    at, n, types = 0, 0, set()
    while at < len(tokens):
        found = next((k for k in range(min(6, len(tokens) - at), 0, -1) if " ".join(tokens[at : at + k]) in gazetteer), 0)
        if found:
            n, types = n + 1, types | gazetteer[" ".join(tokens[at : at + found])]
        at += found or 1
    return n, sorted(types)


def test_phrases_are_leftmost_longest(spark):
    rng = random.Random(9)
    phrases = {("a b", "GPE"), ("a b c", "PERSON"), ("b", "GPE"), ("b", "ORGANIZATION"), ("c d a b", "PERSON"), ("d", "GPE"), ("d d", "ORGANIZATION"), ("  e   f ", "GPE"), ("", "GPE"), ("x", None)}
    gazetteer = defaultdict(set)
    for p, t in phrases:
        if p.strip() and t:
            gazetteer[" ".join(p.split())].add(t)
    rows = [(i, [rng.choice("abcdef") for _ in range(rng.randrange(0, 12))]) for i in range(120)] + [(500, []), (501, None), (502, ["d"] * 4001)]
    trie = phrase_trie(spark.createDataFrame(list(phrases), "phrase string, type string"))
    assert {r.prefix: r.depth for r in trie.collect()}["c d a"] == 3
    got = {r.id: (r.n_matches, r.types) for r in phrase_types(spark.createDataFrame(rows, "id long, tokens array<string>"), trie).collect()}
    assert got == {i: leftmost_longest(t or [], gazetteer) for i, t in rows}
    empty = phrase_trie(spark.createDataFrame([], "phrase string, type string"))
    assert {tuple(r) for r in phrase_types(spark.createDataFrame([(1, ["a"])], "id long, tokens array<string>"), empty).select("id", "n_matches").collect()} == {(1, 0)}


def test_lexicon_stages_learn_in_fit(spark):
    rows = [
        (1, "Run now. Rt this", ["run", "now", "rt", "this"], ["VB", "RB", "NN", "DT"], [("new york", "GPE")]),
        (2, "run. run", ["run", "run"], ["NN", "VB"], [("york", "PERSON")]),
        (3, "walk new york now", ["walk", "new", "york", "now"], ["NN", "JJ", "NNP", "RB"], None),
        (4, "walk", ["walk"], ["VBP"], []),
        (5, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id long, message string, tokens array<string>, tags array<string>, entities array<struct<phrase:string,type:string>>")
    stages = [
        GetVerbNounCount(outputCol="vn"), StartingVerbExtractor(outputCol="starts", variant="none"),
        StartingVerbExtractor(outputCol="starts_rt", variant="none", matchRt=True), EntityCount(outputCol="ents"),
    ]
    fitted = Pipeline(stages=stages).fit(df)
    tags = {r.token: r.tag for r in fitted.stages[0].tables["tags"].collect()}
    assert tags["run"] == "VB" and tags["walk"] == "NN"  # 2 to 1; a tie goes to the first name
    model = reload(spark, fitted)
    assert isinstance(model, PipelineModel)
    got = {r.id: r for r in model.transform(df.drop("tags", "entities")).collect()}
    assert {i: tuple(r.vn) for i, r in got.items()} == {1: (1.0, 1.0), 2: (2.0, 0.0), 3: (0.0, 2.0), 4: (0.0, 1.0), 5: (0.0, 0.0)}
    assert {i: (r.starts, r.starts_rt) for i, r in got.items()} == {1: (True, True), 2: (True, True), 3: (False, False), 4: (False, False), 5: (False, False)}
    assert {i: tuple(r.ents) for i, r in got.items()} == {1: (0.0, 0.0, 0.0), 2: (0.0, 0.0, 0.0), 3: (1.0, 0.0, 0.0), 4: (0.0, 0.0, 0.0), 5: (0.0, 0.0, 0.0)}
    rt = df.where("id = 2").select("id", F.lit("so. RT x").alias("message"), "tokens")
    assert [(r.starts, r.starts_rt) for r in model.transform(rt).collect()] == [(False, True)]


def labelled(spark, n=90):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        hot, wet = rng.random() < 0.5, rng.random() < 0.4
        words = (["fire", "smoke"] if hot else ["calm"]) + (["rain", "flood"] if wet else ["dry"]) + [rng.choice(["x", "y", "z"]) for _ in range(4)]
        rows.append((i, " ".join(words), int(hot), int(wet)))
    return spark.createDataFrame(rows, "id long, message string, hot int, wet int"), ["hot", "wet"], rows


def test_union_features_fit_save_and_predict(spark):
    df, labels, rows = labelled(spark, 40)
    params = {"size": 6, "min_count": 1, "iter": 1, "min_df": 1.0, "max_df": 0.99}
    model, _ = models.fit_multilabel(df, labels, "union", "logistic", clf_params={"C": 1.0}, feature_params=params)
    widths = {r.features.size for r in model.transform(df).select("features").collect()}
    terms = next(len(s.vocabulary) for s in model.stages if hasattr(s, "vocabulary"))
    assert widths == {terms + 6 + 33}
    again = reload(spark, model)
    first = sorted(map(tuple, models.predict_long(model, df, labels).collect()))
    assert first == sorted(map(tuple, models.predict_long(again, df, labels).collect()))
    assert sum(y == p for _, _, y, p in first) > 0.9 * len(first)


def test_kfold_report_scores_every_row_once(spark):
    df, labels, rows = labelled(spark)
    settings = dict(clf_params={"C": 10.0}, feature_params={"min_df": 1.0, "max_df": 0.99})
    scored = models.fold_predictions(df, labels, 3, **settings)
    folds = {r.id: r.fold for r in sampling.assign_folds(df, 3, "id", 11).collect()}
    got = scored.collect()
    assert Counter((r.id, r.label) for r in got) == Counter((r[0], x) for r in rows for x in labels)
    truth = {(r[0], "hot"): r[2] for r in rows} | {(r[0], "wet"): r[3] for r in rows}
    assert all(r.fold == folds[r.id] and r.y == truth[(r.id, r.label)] for r in got)
    report = models.kfold_report(df, labels, 3, **settings).collect()
    assert {(r.fold, r.label): (r.n, r.support) for r in report} == {
        (f, x): (sum(v == f for v in folds.values()), sum(truth[(i, x)] for i, v in folds.items() if v == f)) for f in range(3) for x in labels
    }
    assert all(r.f1 > 0.8 for r in report)


def test_forests_of_a_grid_share_trees(spark):
    fits = models._fits(models.GRID)
    assert len(fits) == 10 and sorted(i for _, own in fits for i in own) == list(range(18))
    assert all(c["clf_params"]["num_trees"] == 50 for c, own in fits if len(own) == 2)
    df, labels, _ = labelled(spark)
    data = models.featurizer("tfidf", min_df=1.0, max_df=0.99).fit(df).transform(df).withColumn("hot", F.col("hot").cast("double"))
    forest = models.make_classifier("forest", "hot", 90, num_trees=6, max_depth=3).fit(data)
    part = models.first_trees(forest, 2)
    assert part.getNumTrees == 2 and part.numFeatures == forest.numFeatures and models.first_trees(forest, 6) is forest
    assert [t.toDebugString.split("\n", 1)[1] for t in part.trees] == [t.toDebugString.split("\n", 1)[1] for t in forest.trees[:2]]
    rows = part.transform(data).select(*[vector_to_array(c).alias(c) for c in ("raw_hot", "prob_hot")], "pred_hot").collect()
    assert len(rows) == 90 and all(abs(sum(r.raw_hot) - 2) < 1e-9 for r in rows)


def test_grid_search_scores_all_candidates(spark):
    df, labels, _ = labelled(spark, 60)
    grid = [{"clf_kind": "forest", "balanced": False, "clf_params": {"num_trees": n, "max_depth": 3, "max_features": "0.8"}} for n in (2, 5)]
    grid += [{"clf_kind": "logistic", "balanced": True, "clf_params": {"C": 1.0}}]
    for scorer in ("recall_weighted", "f1_weighted"):
        scores = models.grid_search(df, labels, grid, 2, scorer=scorer)
        assert [i for i, _, _ in scores] == [0, 1, 2] and all(0.5 < s <= 1 for _, _, s in scores)


def test_resampling_stores_narrow_steps(spark):
    df, labels, _ = labelled(spark)
    df = df.withColumn("wide", F.repeat(F.lit("text "), 10))
    out = sampling.resample_training(df, ("hot",), 0.9, "wet", 0.4)
    assert out.columns == [*df.columns, "rowkey"]
    rows = out.collect()
    assert len({r.rowkey for r in rows}) == len(rows) and all(int(r.rowkey.split("#")[0]) == r.id for r in rows)
    texts = {r.id: r.message for r in df.collect()}
    assert all(r.message == texts[r.id] for r in rows)
    n_pos = sum(r.wet == 1 for r in rows)
    assert sum(r.wet == 0 for r in rows) == int(n_pos * 0.4)


def test_fitted_vectors_have_no_vocabulary_limit(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(features, "ML_TERMS", 3)
    rows = [(k, "apple banana cherries lemon") for k in range(6)] + [(k, "water apple apple") for k in range(6, 11)]
    rows += [(11, "apple rare"), (None, "water"), (12, None), (13, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got, same = (Counter(map(tuple, REGISTRY[q].fn(spark, str(tmp_path)).collect())) for q in ("ml_tfidf_vectors", "fitted_tfidf"))
    assert {t for i, t, _ in got if i == 0} == {"apple", "banana", "cherrie", "lemon"} and got == same


def test_term_weights_match_the_capped_stages(spark):
    _, df = corpus(spark)
    df = df.where("tokens IS NOT NULL")
    capped, table = (
        Pipeline(stages=features.tfidf_stages("tokens", "w", size, 2.0, 0.8, None, sublinear, tables=size is None)).fit(df)
        for size, sublinear in ((100, True), (None, True))
    )
    assert {r.term: r["index"] for r in table.stages[0].tables["vocabulary"].collect()}.keys() == set(capped.stages[0].vocabulary)

    def named(model, terms):
        out = model.transform(df)
        assert {r.w.size for r in out.select("w").collect()} == {len(terms)}
        return Counter((r.id, tuple(sorted((terms[i], round(x, 9)) for i, x in zip(r.w.indices.tolist(), r.w.values.tolist())))) for r in out.collect())

    want = named(capped, dict(enumerate(capped.stages[0].vocabulary)))
    for m in (table, reload(spark, table)):
        terms = {r["index"]: r.term for r in m.stages[0].tables["vocabulary"].collect()}
        assert named(m, terms) == want


@pytest.mark.parametrize("rows", [lexicon.DEFAULT_BROADCAST_ROWS, 0])
def test_lexicon_results_meet_rows_that_stay(spark, monkeypatch, rows):
    should = lexicon.should_broadcast
    monkeypatch.setattr(lexicon, "should_broadcast", lambda df, r, b: should(df, min(r, rows), b))
    data = [(1, ["run", "x", "run"], ["VB", "NN", "VB"]), (1, ["run", "x", "run"], None), (None, ["x"], None), (2, None, None), (3, [], None)]
    df = spark.createDataFrame(data, "id long, tokens array<string>, tags array<string>")
    out = GetVerbNounCount(outputCol="vn").fit(df).transform(df.select("id", "tokens"))
    assert Counter((r.id, tuple(r.vn)) for r in out.collect()) == {(1, (2.0, 1.0)): 2, (None, (0.0, 1.0)): 1, (2, (0.0, 0.0)): 1, (3, (0.0, 0.0)): 1}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert ("rightHint=(strategy=broadcast)" in plan) == bool(rows) and "Aggregate" not in plan


def test_boosted_trees_on_a_vocabulary_table(spark, monkeypatch):
    monkeypatch.setattr(features, "ML_TERMS", 3)
    df, labels, rows = labelled(spark, 40)
    settings = dict(clf_params={"max_iter": 2, "max_depth": 3}, feature_params={"vocab_size": None, "min_df": 1.0, "max_df": 0.99})
    model, _ = models.fit_multilabel(df, labels, "tfidf", "gbt", **settings)
    first = sorted(map(tuple, models.predict_long(model, df, labels).collect()))
    assert first == sorted(map(tuple, models.predict_long(reload(spark, model), df, labels).collect()))
    assert len(first) == 80 and sum(y == p for _, _, y, p in first) > 0.9 * len(first)
