"""Top-k search and mixing against brute force."""

import math
import random
from collections import Counter

import pytest
from brute import SEPARATED, targets, top_k
from pyspark.sql import functions as F

from msgtriage.llm import mixing, va_topk

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("k,query_rows", [(10, 1024), (3, 2)])
def test_top_k_equals_brute_force(spark, k, query_rows):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(900)]
    rows += [(1000 + i, [0.5] * 8) for i in range(30)]  # ties
    rows += [(100, [0.25] * 8), (100, [0.25] * 8), (None, [0.9] * 8)]  # repeated rows, a null id
    rows += [(2000, None), (2001, []), (2100, [0.1, None]), (2200, [NAN] * 8), (2300, [INF] * 8), (2400, [1e9] * 8)]
    rows += [(3000, [0.1, 0.2]), (3001, [0.3, -0.5]), (3100, [1.0])]  # other lengths
    docs = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, block int").repartition(3)
    got = [tuple(r) for r in va_topk.search(docs, F.col("vec_id") % 100 == 0, k=k, query_rows=query_rows).collect()]
    import numpy as np

    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert Counter(got) == Counter(top_k(exact, k))


def test_top_k_of_huge_components(spark):
    big = [(100, [1.0, 0.0]), (200, [1e30, -1.0]), (3, [200000.0, 0.0]), (4, [1.0, 1.0]), (5, [3e38, 1.0]), (6, [-3e38, 2e5]), (7, [2e30, 0.0]), (8, [float(2**53), 3.0])]
    docs = spark.createDataFrame(big, "vec_id long, embedding array<double>").repartition(2)
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in big}
    want = []
    for q in (100, 200):
        scores = [(max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole[q], whole[i])))), i) for i in whole if i != q]
        scores.sort(key=lambda x: (-x[0], x[1]))
        want += [(q, r + 1, i, s) for r, (s, i) in enumerate(scores[:3])]
    assert Counter(tuple(r) for r in va_topk.search(docs, F.col("vec_id") % 100 == 0, k=3).collect()) == Counter(want)


def test_top_k_without_vectors_or_queries(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert va_topk.search(none, F.col("vec_id") % 100 == 0).collect() == []
    one = spark.createDataFrame([(100, [1.0]), (7, None)], "vec_id long, embedding array<float>")
    assert va_topk.search(one, F.col("vec_id") % 100 == 0).collect() == []
    assert va_topk.search(one, F.col("vec_id") % 100 == 1).collect() == []


def corpus(rng):
    rows = []
    for k, source in enumerate(["a", "b", "ü", None, "c", "empty", "single"]):
        for _ in range({"single": 1, "a": 300}.get(source, 60 + 10 * k)):
            n = 0 if source == "empty" else int(rng.paretovariate(1.2) * 5)
            rows.append((len(rows), source, " \t".join(["w"] * n) + rng.choice(["", "\n"])))
    rows += [(1, "a", None), (1, "a", "x y"), (1, "a", "x y"), (None, "b", "z"), (None, "b", "z"), (None, None, "")]
    return rows


def test_mixing_meets_targets(spark):
    rows = corpus(random.Random(6))
    docs = spark.createDataFrame([(i, s, t, 5) for i, s, t in rows], "doc_id long, source string, text string, size int").repartition(4)
    got = mixing.copies(docs, cell_rows=7).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, len(SEPARATED.findall(t or ""))) for i, s, t in rows)
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += len(SEPARATED.findall(t or ""))
    want = targets(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.n_copies <= 2
        taken[r.source] += r.size * r.n_copies
    for s in sizes:
        if s not in ("single", "empty"):
            assert abs(taken[s] - want[s]) <= 0.05 * want[s] + 5, s
    again = mixing.copies(docs.repartition(7), cell_rows=7).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mixed_corpus_repeats_rows(spark):
    rows = corpus(random.Random(6))
    docs = spark.createDataFrame([(i, s, t, 5) for i, s, t in rows], "doc_id long, source string, text string, size int").repartition(4)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "copy"]
    per = Counter((r.doc_id, r.source, r.text) for r in mixed.collect())
    drawn = mixing.copies(docs).agg(F.sum("n_copies")).first()[0]
    assert sum(per.values()) == drawn and set(per) <= {(i, s, t) for i, s, t in rows}
    assert mixing.mix(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(docs, copy_column="size")


def test_word_count(spark):
    texts = [None, "", " ", "a", " a", "a ", " a  b\t\nc\x0b\x0c\r", " ", "é ü x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", mixing.word_count(F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in rows} == {t: len(SEPARATED.findall(t or "")) for t in texts}
