import math

from pyspark.sql import functions as F

from msgtriage.operators import sampling


def ids(spark, n):
    return spark.range(n).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("t"))


def test_dense_index_is_permutation(spark):
    out = sampling.dense_random_index(ids(spark, 1000), "id", 7, "idx", prefix_digits=2)
    got = sorted(r.idx for r in out.collect())
    assert got == list(range(1000))


def test_dense_index_matches_global_order(spark):
    df = ids(spark, 300)
    out = sampling.dense_random_index(df, "id", 5, "idx").collect()
    import hashlib

    expect = sorted(range(300), key=lambda i: (hashlib.md5(f"5:{i}".encode()).hexdigest(), i))
    assert {r.id: r.idx for r in out} == {i: k for k, i in enumerate(expect)}


def test_split_sizes_exact_and_disjoint(spark):
    df = ids(spark, 101)
    out = sampling.split_frame(df, (0.7, 0.15, 0.15), ("train", "valid", "test"), "id", 3)
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert counts == {"test": math.ceil(0.15 * 101), "valid": math.ceil(0.15 * 101),
                      "train": 101 - 2 * math.ceil(0.15 * 101)}
    assert out.select("id").distinct().count() == 101


def test_folds_exhaustive(spark):
    out = sampling.assign_folds(ids(spark, 100), 3, "id", 11)
    counts = sorted(r["count"] for r in out.groupBy("fold").count().collect())
    assert counts == [33, 33, 34]


def test_upsample_counts_exact(spark):
    df = ids(spark, 90)  # 30 positives, 60 negatives
    up = sampling.upsample(df, "t", 0.9, "id", 11)
    assert up.where("draw < 0").count() == 60
    drawn = up.where("draw >= 0")
    assert drawn.count() == int(60 * 0.9)
    assert drawn.where("t = 1").count() == drawn.count()
    down = sampling.resample_negatives(df, "t", 0.4, "id", 11)
    assert down.where("draw >= 0 AND t = 0").count() == int(30 * 0.4)


def test_sample_rows(spark):
    df = ids(spark, 50)
    assert sampling.sample_rows(df, 20, "id", 1).count() == 20
    assert sampling.sample_rows(df, 0, "id", 1).count() == 50
    import pytest

    with pytest.raises(ValueError):
        sampling.sample_rows(df, 51, "id", 1)


def test_resample_training_sequence(spark):
    df = ids(spark, 120).withColumn("u", (F.col("id") % 4 == 0).cast("int"))
    out = sampling.resample_training(df, ["t"], 0.5, "u", 0.4, "id", 11)
    # step 1: keep 80 negatives of t, draw int(80 * .5) = 40 positives of t
    # step 2: on those 120 rows, keep the u positives, draw int(n_u * .4) u negatives
    step1 = sampling.upsample(df.withColumn("rowkey", F.col("id").cast("string")), "t", 0.5, "rowkey", 11)
    n_u = step1.where("u = 1").count()
    assert out.count() == n_u + int(n_u * 0.4)
    assert out.select("rowkey").distinct().count() == out.count()
