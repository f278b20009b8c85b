"""Queries: sampling / splitting / resampling (H0-H5, F12) and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgtriage.operators import ingest, metrics, sampling
from msgtriage.plans import etl
from msgtriage.plans.fixtures import predictions_fx, table, with_fixtures
from msgtriage.plans.registry import r6, register

SPLIT_SEED = 42
FOLD_SEED = 11
RESAMPLE_SEED = 11


def _idx_sql(seed, source, out="idx", where=""):
    return (
        f"SELECT *, row_number() OVER (ORDER BY md5('{seed}:' || CAST(id AS VARCHAR)), id) - 1 AS {out} "
        f"FROM {source} {where}"
    )


def _train_ctes():
    return (
        ("idx", _idx_sql(SPLIT_SEED, "training_fx")),
        ("cnt", "SELECT count(*) AS n FROM idx"),
        ("train", "SELECT i.* FROM idx i, cnt WHERE i.idx >= CAST(ceil(CAST(0.2 AS DOUBLE) * cnt.n) AS BIGINT)"),
    )


def _train_rows(spark, sf_dir):
    train, labels = etl.training_table(spark, sf_dir)
    split = sampling.split_frame(train, (0.8, 0.2), ("train", "test"), "id", SPLIT_SEED)
    return split.where(F.col("split") == "train").drop("split"), labels


@register(
    "random_index",
    ("H0",),
    with_fixtures("SELECT id, idx FROM idx", "training_fx", ctes=(("idx", _idx_sql(SPLIT_SEED, "training_fx")),)),
)
def q_random_index(spark, sf_dir):
    train, _ = etl.training_table(spark, sf_dir)
    return sampling.dense_random_index(train, "id", SPLIT_SEED, "idx").select("id", "idx")


@register(
    "sample_rows",
    ("H1",),
    with_fixtures(
        "SELECT i.id FROM idx i, cnt WHERE i.idx < cnt.n // 2",
        "training_fx",
        ctes=(("idx", _idx_sql(SPLIT_SEED, "training_fx")), ("cnt", "SELECT count(*) AS n FROM idx")),
    ),
)
def q_sample_rows(spark, sf_dir):
    train, _ = etl.training_table(spark, sf_dir)
    n = train.count() // 2
    return sampling.sample_rows(train, n, "id", SPLIT_SEED).select("id")


@register(
    "train_test_split",
    ("H2",),
    with_fixtures(
        """SELECT i.id, CASE WHEN i.idx < CAST(ceil(CAST(0.2 AS DOUBLE) * cnt.n) AS BIGINT)
                             THEN 'test' ELSE 'train' END AS split
           FROM idx i, cnt""",
        "training_fx",
        ctes=(("idx", _idx_sql(SPLIT_SEED, "training_fx")), ("cnt", "SELECT count(*) AS n FROM idx")),
    ),
)
def q_train_test_split(spark, sf_dir):
    train, _ = etl.training_table(spark, sf_dir)
    return sampling.split_frame(train, (0.8, 0.2), ("train", "test"), "id", SPLIT_SEED).select(
        "id", "split"
    )


@register(
    "three_way_split",
    ("H2",),
    with_fixtures(
        """SELECT i.id,
                  CASE WHEN i.idx < t.n_test THEN 'test'
                       WHEN i.idx < t.n_test + t.n_valid THEN 'valid'
                       ELSE 'train' END AS split
           FROM idx i,
                (SELECT CAST(ceil(CAST(0.15 AS DOUBLE) * n) AS BIGINT) AS n_test,
                        CAST(ceil(CAST(0.15 AS DOUBLE) * n) AS BIGINT) AS n_valid FROM cnt) t""",
        "training_fx",
        ctes=(("idx", _idx_sql(SPLIT_SEED, "training_fx")), ("cnt", "SELECT count(*) AS n FROM idx")),
    ),
)
def q_three_way_split(spark, sf_dir):
    train, _ = etl.training_table(spark, sf_dir)
    return sampling.split_frame(
        train, (0.7, 0.15, 0.15), ("train", "valid", "test"), "id", SPLIT_SEED
    ).select("id", "split")


_FOLD_SQL = """CAST(CASE WHEN i.idx < (c.n % 3) * (c.n // 3 + 1) THEN i.idx // (c.n // 3 + 1)
                    ELSE (c.n % 3) + (i.idx - (c.n % 3) * (c.n // 3 + 1)) // (c.n // 3) END AS INTEGER)"""


@register(
    "kfold_assignment",
    ("H3",),
    with_fixtures(
        f"SELECT i.id, {_FOLD_SQL} AS fold FROM idx i, cnt c",
        "training_fx",
        ctes=(("idx", _idx_sql(FOLD_SEED, "training_fx")), ("cnt", "SELECT count(*) AS n FROM idx")),
    ),
)
def q_kfold(spark, sf_dir):
    train, _ = etl.training_table(spark, sf_dir)
    return sampling.assign_folds(train, 3, "id", FOLD_SEED).select("id", "fold")


def _resample_sql(target, kept_value, fraction, tag):
    drawn_value = 1 - kept_value
    return with_fixtures(
        f"""SELECT id, CAST(-1 AS BIGINT) AS draw, {target} FROM train WHERE {target} = {kept_value}
            UNION ALL
            SELECT p.id, k.d AS draw, p.{target} FROM picks k JOIN pool p ON p.pick = k.pick""",
        "training_fx",
        ctes=(
            *_train_ctes(),
            ("pool", f"SELECT id, {target}, row_number() OVER (ORDER BY md5('{RESAMPLE_SEED}:' || CAST(id AS VARCHAR)), id) - 1 AS pick FROM train WHERE {target} = {drawn_value}"),
            ("npool", "SELECT count(*) AS n FROM pool"),
            ("nkept", f"SELECT count(*) AS n FROM train WHERE {target} = {kept_value}"),
            ("draws", f"SELECT unnest(range(0, CAST(floor((SELECT n FROM nkept) * CAST({fraction} AS DOUBLE)) AS BIGINT))) AS d"),
            ("picks", f"SELECT d, CAST(('0x' || substr(md5('{RESAMPLE_SEED}:{tag}:' || CAST(d AS VARCHAR)), 1, 15)) AS BIGINT) % (SELECT n FROM npool) AS pick FROM draws"),
        ),
    )


@register("upsampled_train", ("H4", "D3"), _resample_sql("toxic", 0, 0.9, "up:toxic"))
def q_upsampled(spark, sf_dir):
    train, _ = _train_rows(spark, sf_dir)
    out = sampling.upsample(train, "toxic", 0.9, "id", RESAMPLE_SEED)
    return out.select("id", "draw", "toxic")


@register("resampled_negatives", ("H5", "D3"), _resample_sql("long", 1, 0.4, "down:long"))
def q_resampled_negatives(spark, sf_dir):
    train, _ = _train_rows(spark, sf_dir)
    out = sampling.resample_negatives(train, "long", 0.4, "id", RESAMPLE_SEED)
    return out.select("id", "draw", "long")


@register(
    "class_weights",
    ("F12", "E4"),
    with_fixtures(
        """SELECT label, y, n_class,
                  round(CAST(sum(n_class) OVER (PARTITION BY label) AS DOUBLE)
                        / (count(*) OVER (PARTITION BY label) * n_class), 6) AS weight
           FROM (SELECT label, y, count(*) AS n_class FROM (
                   SELECT 'related' AS label, related AS y FROM training_fx
                   UNION ALL SELECT 'toxic', toxic FROM training_fx
                   UNION ALL SELECT 'long', long FROM training_fx
                   UNION ALL SELECT 'multi_line', multi_line FROM training_fx) u
                 GROUP BY label, y) c""",
        "training_fx",
    ),
)
def q_class_weights(spark, sf_dir):
    train, labels = etl.training_table(spark, sf_dir)
    long = ingest.labels_long(train, labels, "id")
    w = metrics.class_weights(long)
    return w.select("label", "y", "n_class", r6("weight").alias("weight"))


# --------------------------------------------------------------------------
# Metrics on fixed predictions
# --------------------------------------------------------------------------


def report_sql(source: str, by: str = "label") -> str:
    """DuckDB twin of ``metrics.label_report`` (unrounded)."""
    return f"""
    SELECT {by}, tp, fp, fn, tn, n,
           CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS p1,
           CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS r1,
           CASE WHEN tn + fn = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / (tn + fn) END AS p0,
           CASE WHEN tn + fp = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / (tn + fp) END AS r0
    FROM (SELECT {by}, count_if(y = 1 AND yhat = 1) AS tp, count_if(y = 0 AND yhat = 1) AS fp,
                 count_if(y = 1 AND yhat = 0) AS fn, count_if(y = 0 AND yhat = 0) AS tn,
                 count(*) AS n
          FROM {source} GROUP BY {by}) c"""


def final_report_sql(rates: str, by: str = "label", digits: int = 4) -> str:
    def f1(p, r):
        return f"(CASE WHEN {p} + {r} = 0 THEN 0.0 ELSE 2 * {p} * {r} / ({p} + {r}) END)"

    def w(v1, v0):
        return f"(CASE WHEN n = 0 THEN 0.0 ELSE ((tp + fn) * {v1} + (tn + fp) * {v0}) / n END)"

    return f"""SELECT {by},
        round_even({w(f1('p1', 'r1'), f1('p0', 'r0'))}, {digits}) AS f1,
        round_even({w('p1', 'p0')}, {digits}) AS precision,
        round_even({w('r1', 'r0')}, {digits}) AS recall,
        round_even(CASE WHEN n = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / n END, {digits}) AS accuracy
        FROM {rates}"""


@register(
    "label_metrics",
    ("F9", "F11"),
    with_fixtures(
        final_report_sql("rates"), "predictions_fx", ctes=(("rates", report_sql("predictions_fx")),)
    ),
)
def q_label_metrics(spark, sf_dir):
    return metrics.label_report(predictions_fx(spark, sf_dir), ("label",), 4)


@register(
    "metric_summary",
    ("F10",),
    with_fixtures(
        "\nUNION ALL\n".join(
            f"""SELECT '{m}' AS metric, round(avg({m}), 6) AS mean,
                       round(CAST(median({m}) AS DOUBLE), 6) AS median,
                       round(stddev_samp({m}), 6) AS std FROM report"""
            for m in metrics.METRICS
        ),
        "predictions_fx",
        ctes=(("rates", report_sql("predictions_fx")), ("report", final_report_sql("rates"))),
    ),
)
def q_metric_summary(spark, sf_dir):
    rep = metrics.label_report(predictions_fx(spark, sf_dir), ("label",), 4)
    s = metrics.report_summary(rep)
    return s.select("metric", r6("mean").alias("mean"), r6("median").alias("median"), r6("std").alias("std"))


@register(
    "multilabel_scores",
    ("K11",),
    with_fixtures(
        """SELECT round(CASE WHEN sum(tp + fn) = 0 THEN 0.0 ELSE CAST(sum(tp) AS DOUBLE) / sum(tp + fn) END, 6) AS recall_weighted,
                  round(CASE WHEN sum(tp + fn) = 0 THEN 0.0
                             ELSE sum((tp + fn) * CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END)
                                  / sum(tp + fn) END, 6) AS f1_weighted
           FROM rates""",
        "predictions_fx",
        ctes=(("rates", report_sql("predictions_fx")),),
    ),
)
def q_multilabel_scores(spark, sf_dir):
    s = metrics.multilabel_scores(predictions_fx(spark, sf_dir))
    return s.select(r6("recall_weighted").alias("recall_weighted"), r6("f1_weighted").alias("f1_weighted"))


@register(
    "fold_metrics",
    ("K12", "H3"),
    with_fixtures(
        final_report_sql("rates", "fold, label"),
        "predictions_fx",
        ctes=(
            ("ids", "SELECT doc_id AS id FROM labels"),
            ("idx", _idx_sql(FOLD_SEED, "ids")),
            ("cnt", "SELECT count(*) AS n FROM idx"),
            ("folds", f"SELECT i.id, {_FOLD_SQL} AS fold FROM idx i, cnt c"),
            ("fp", "SELECT p.*, f.fold FROM predictions_fx p JOIN folds f ON p.id = f.id"),
            ("rates", report_sql("fp", "fold, label")),
        ),
    ),
)
def q_fold_metrics(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    folds = sampling.assign_folds(ids, 3, "id", FOLD_SEED)
    pred = predictions_fx(spark, sf_dir).join(folds, "id")
    return metrics.label_report(pred, ("fold", "label"), 4)
