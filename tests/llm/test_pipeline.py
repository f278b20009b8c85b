"""The pipeline on a small corpus with planted cases, and every stage on odd rows."""

import random

import pytest
from brute import base_spans, components, decontamination
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from msgtriage.llm import langid
from msgtriage.llm.queries import ORACLE_SQL, QUERIES

WORDS = {"en": "the house water under thing and was that with from".split(), "fr": "maison bonjour eau rue étage dans pour les une avec".split()}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)

    def text(lang, n):
        return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", f"x{rng.randrange(99)}"]) for _ in range(n))

    items = [(k, text("en", 25)) for k in range(6)]
    rows = []
    for k in range(60):
        lang = rng.choice(["en", "en", "fr"])
        rows.append((k, text(lang, 60), lang, rng.choice(["s1", "s2", None])))
    rows += [(100 + k, rows[k][1] + " last", rows[k][2], "s1") for k in range(8)]  # near copies
    rows += [(200 + k, rows[k][1], rows[k][2], "s2") for k in range(8)]  # exact copies
    rows += [(300 + k, text("en", 40) + " " + items[k][1].upper() + " " + text("en", 40), "en", "s3") for k in range(6)]
    rows += [(400, text("en", 30) + " me@x.example.com 4111111111111111 " + text("en", 30), "en", "s3")]
    rows += [(500, None, None, None), (501, "", "en", "s1"), (502, "12345 ... 678", None, "s1"), (None, text("en", 50), "en", "s4"), (0, rows[0][1], rows[0][2], rows[0][3])]
    folder = str(tmp_path_factory.mktemp("sf"))
    docs = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_stages(spark, corpus):
    folder, rows, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, out = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), f"test-{name}")
        out[name] = docs.collect()
        assert docs.columns[:5] == columns
    # language ID rejects what has no letters and nothing else
    assert sorted(str(r.doc_id) for r in out["language"]) == sorted(str(i) for i, t, _, _ in rows if i not in (500, 501, 502))
    # of each group of copies the smallest id stays, once
    groups = components([(r.doc_id, r.text) for r in out["language"]])
    want = {c for _, _, c in groups if c is not None}
    assert sorted(r.doc_id for r in out["near_duplicates"] if r.doc_id is not None) == sorted(want)
    assert sum(r.doc_id is None for r in out["near_duplicates"]) == 1
    # no window of an item is left, clean documents are as they were
    found = {r[0]: r[5] for r in decontamination([(r.doc_id, r.text) for r in out["near_duplicates"]], items)}
    assert sum(found.values()) == 6
    assert not any(r[5] for r in decontamination([(r.doc_id, r.text) for r in out["decontamination"]], items))
    before = {r.doc_id: r.text for r in out["near_duplicates"]}
    assert {r.doc_id: r.text for r in out["decontamination"] if not found[r.doc_id]} == {i: t for i, t in before.items() if not found[i]}
    assert all(r.n_chars == len(r.text) for r in out["decontamination"])
    # personal data is replaced
    assert not any(base_spans(r.text) for r in out["personal_data"])
    assert [r.text.count("<EMAIL> <CARD>") for r in out["personal_data"] if r.doc_id == 400] == [1]
    # every copy is a row of the stage before
    kept = {(r.doc_id, r.text) for r in out["personal_data"]}
    assert {(r.doc_id, r.text) for r in out["mixing"]} <= kept and max(r.mix_copy for r in out["mixing"]) <= 2


def test_language_stage_without_any_language(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    got = corpus_pipeline.keep_known_languages(spark, docs, corpus[0])
    assert got.columns == docs.columns
    assert got.count() == docs.where("text rlike '[a-z]'").count() > 0


def test_language_stage_rejects_languages_not_learned(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    texts = ["вода дом улица " * 30, "水家街 " * 40, "zqxj wvkq xkcdq jjqz " * 30]
    more = spark.createDataFrame([(9000 + k, t, None, "s1", len(t)) for k, t in enumerate(texts)], docs.schema)
    got = [r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs.unionByName(more), corpus[0]).collect()]
    assert not {9000, 9001, 9002} & set(got)
    assert len(got) == docs.where("text rlike '[a-z]'").count()


def test_run_equals_stages(spark, corpus):
    folder, rows, _ = corpus
    got = corpus_pipeline.run(spark, folder)
    assert got.count() > 0 and got.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_copy"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:1] + corpus_pipeline.STAGES[2:])
def test_stage_on_empty_table(spark, corpus, name, stage):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").where(F.lit(False))
    assert stage(spark, docs, corpus[0]).collect() == []


def test_registered():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names and {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 11))
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert langid.UNKNOWN == "und" and 4 <= len(corpus_pipeline.STAGES) <= 5
