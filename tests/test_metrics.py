import random

from msgtriage.operators import metrics


def brute(y, yh):
    n = len(y)
    out = {}
    res = {}
    for c in (0, 1):
        tp = sum(1 for a, b in zip(y, yh) if a == c and b == c)
        pp = sum(1 for b in yh if b == c)
        sp = sum(1 for a in y if a == c)
        p = tp / pp if pp else 0.0
        r = tp / sp if sp else 0.0
        f = 2 * p * r / (p + r) if p + r else 0.0
        res[c] = (p, r, f, sp)
    for i, k in enumerate(("precision", "recall", "f1")):
        out[k] = sum(res[c][i] * res[c][3] for c in (0, 1)) / n
    out["accuracy"] = sum(1 for a, b in zip(y, yh) if a == b) / n
    return out


def test_label_report_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    truth = {}
    for label in ("a", "b", "c"):
        ys = [rnd.randint(0, 1) for _ in range(57)]
        yh = [rnd.randint(0, 1) if label != "c" else 0 for _ in range(57)]
        truth[label] = brute(ys, yh)
        rows += [(i, label, y, h) for i, (y, h) in enumerate(zip(ys, yh))]
    df = spark.createDataFrame(rows, "id int, label string, y int, yhat int")
    got = {r.label: r for r in metrics.label_report(df, ("label",), None).collect()}
    for label, exp in truth.items():
        for k, v in exp.items():
            assert abs(got[label][k] - v) < 1e-12, (label, k)
        # identity: weighted recall equals accuracy
        assert abs(got[label]["recall"] - got[label]["accuracy"]) < 1e-12


def test_multilabel_scores(spark):
    df = spark.createDataFrame(
        [(1, "a", 1, 1), (2, "a", 1, 0), (3, "a", 0, 1), (1, "b", 1, 1), (2, "b", 0, 0)],
        "id int, label string, y int, yhat int",
    )
    r = metrics.multilabel_scores(df).first()
    assert abs(r.recall_weighted - 2 / 3) < 1e-12
    # label a: p=.5 r=.5 f1=.5 support 2; label b: f1=1 support 1
    assert abs(r.f1_weighted - (2 * 0.5 + 1 * 1.0) / 3) < 1e-12


def test_class_weights(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", 0), ("a", 0)], "label string, y int")
    w = {r.y: r.weight for r in metrics.class_weights(df).collect()}
    assert w == {0: 4 / (2 * 3), 1: 4 / (2 * 1)}


def test_balanced_weight_columns_match_class_weights(spark):
    from msgtriage.operators.models import balanced_weight_columns

    df = spark.createDataFrame([(1, 0), (0, 0), (0, 1), (0, 1), (0, 0)], "a int, b int")
    w = balanced_weight_columns(df, ["a", "b"])
    got = df.select(w["a"].alias("wa"), w["b"].alias("wb"), "a", "b").collect()
    for r in got:
        assert abs(r.wa - (5 / (2 * (1 if r.a == 1 else 4)))) < 1e-12
        assert abs(r.wb - (5 / (2 * (2 if r.b == 1 else 3)))) < 1e-12
