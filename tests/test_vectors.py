import random

import numpy as np
from pyspark.sql import functions as F

from msgtriage.operators import vectors


def vocab(spark, dim=4, n=30, seed=1):
    rnd = random.Random(seed)
    rows = [(f"w{i}", [rnd.uniform(-1, 1) for _ in range(dim)]) for i in range(n)]
    return rows, spark.createDataFrame(rows, "word string, vector array<double>")


def test_sentence_vector_recurrence(spark):
    rows, vec = vocab(spark)
    table = dict(rows)
    docs = [(1, ["w1", "zz", "w2", "w3"]), (2, ["nope"]), (3, [f"w{i % 30}" for i in range(200)])]
    df = spark.createDataFrame(docs, "id int, tokens array<string>")
    got = {r.id: r.sentvec for r in vectors.sentence_vectors(df, vec, 4, "id", "tokens").collect()}
    for i, toks in docs:
        v = np.zeros(4)
        for t in toks:
            if t in table:
                v = (np.array(table[t]) + v) / 4
        assert np.allclose(got[i], v, rtol=1e-12, atol=1e-300), i


def test_global_median_exact(spark):
    rnd = random.Random(5)
    vals = [rnd.gauss(0, 1) for _ in range(5001)] + [float("nan")] * 10
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    clean = [v for v in vals if v == v]
    # a small collect limit forces several narrowing passes
    got = vectors.global_median(df, "x", accuracy=100, collect_limit=300)
    assert got == float(np.median(clean))
    even = df.where(F.col("x") > -10).limit(0)
    assert vectors.global_median(even, "x") is None


def test_most_similar_brute_force(spark):
    rows, vec = vocab(spark, dim=5, n=40, seed=2)
    table = {w: np.array(v) for w, v in rows}
    unit = {w: v / np.linalg.norm(v) for w, v in table.items()}
    q = (unit["w1"] + unit["w2"] - unit["w3"]) / 3
    q = q / np.linalg.norm(q)
    expect = sorted(
        ((w, float(unit[w] @ q)) for w in table if w not in ("w1", "w2", "w3")),
        key=lambda t: (-t[1], t[0]),
    )[:5]
    got = [(r.word, r.score) for r in vectors.most_similar(vec, ["w1", "w2"], ["w3"], 5).collect()]
    assert [w for w, _ in got] == [w for w, _ in expect]
    assert np.allclose([s for _, s in got], [s for _, s in expect])


def test_vectors_beyond_a_broadcast_come_in_blocks(spark):
    rows, _ = vocab(spark, dim=4, n=30)
    rows += [("w3", [1.0, 2.0, 3.0, 4.0]), ("w5", rows[7][1]), ("w6", None)]  # words listed twice, a vector of two words, none
    vec = spark.createDataFrame(rows, "word string, vector array<double>")
    docs = [(i, [f"w{(i * j) % 33}" for j in range(i)]) for i in range(40)] + [(None, ["w1"]), (50, None), (51, ["w6"])]
    df = spark.createDataFrame(docs, "id int, tokens array<string>")
    for f, out in ((vectors.sentence_vectors, "sentvec"), (vectors.mean_vectors, "meanvec")):
        plain = {r.id: r[out] for r in f(df, vec, 4, "id", "tokens").collect()}
        for block in (100_000, 300):
            got = {r.id: r[out] for r in f(df, vec, 4, "id", "tokens", broadcast_rows=0, block_bytes=block).collect()}
            assert got.keys() == plain.keys()
            for k, v in plain.items():
                assert np.allclose(np.array(got[k], float), np.array(v, float), rtol=1e-12, equal_nan=True), (out, block, k)
