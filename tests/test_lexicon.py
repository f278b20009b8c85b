import numpy as np
from pyspark.sql import functions as F

from msgtriage.operators import lexicon


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_spell_matches_brute_force(spark):
    known = {"water": 10, "food": 8, "flood": 5, "shelter": 3, "fire": 7, "wafer": 10, "fool": 8}
    words = ["watr", "fod", "flod", "shelterr", "xyzzy", "fire", "wster", "fo"]
    vocab = spark.createDataFrame(list(known.items()), "word string, freq long")
    wdf = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: (r.suggestion, r.distance) for r in lexicon.spell_suggestions(wdf, vocab).collect()}
    for w in words:
        if w in known:
            assert w not in got
            continue
        cands = sorted(
            ((lev(w, k), -f, k) for k, f in known.items() if lev(w, k) <= 2)
        )
        exp = (cands[0][2], cands[0][0]) if cands else (w, None)
        assert got[w] == exp, w


def test_lemmatize_keeps_order(spark):
    df = spark.createDataFrame([(1, ["cats", "run", "dogs"]), (2, [])], "id int, tokens array<string>")
    lex = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "form string, lemma string")
    got = {r.id: r.lemmas for r in lexicon.lemmatize(df, lex, "id").collect()}
    assert got == {1: ["cat", "run", "dog"], 2: []}


def test_entity_flags_ngrams(spark):
    df = spark.createDataFrame([(1, ["new", "york", "city"]), (2, ["paris"])], "id int, tokens array<string>")
    gaz = spark.createDataFrame([("new york", "GPE"), ("paris", "GPE"), ("york city fc", "ORGANIZATION")],
                                "phrase string, type string")
    got = {r.id: (r.GPE, r.PERSON, r.ORGANIZATION) for r in lexicon.entity_flags(df, gaz, "id").collect()}
    assert got == {1: (1, 0, 0), 2: (1, 0, 0)}


def test_spell_segments_equal_all_pairs(spark):
    import random

    rng = random.Random(4)
    known = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))): rng.randrange(1, 5) for _ in range(60)}
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 11))) for _ in range(200)} | {"x" * 3000}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    want = {}
    for w in words - set(known):
        close = [(d, -f, k) for k, f in known.items() if abs(len(k) - len(w)) <= 2 and (d := distance(w, k)) <= 2]
        want[w] = (min(close)[2], min(close)[0]) if close else (w, None)
    got = lexicon.spell_suggestions(
        spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame(list(known.items()), "word string, freq long")
    )
    assert {r.word: (r.suggestion, r.distance) for r in got.collect()} == want


def test_spell_keys_cover_every_length(spark):
    """Words around the length where the kind of key changes, letters beyond ASCII, and words of one or two letters."""
    rng = np.random.default_rng(8)
    known = {"".join(rng.choice(list("abé"), n)) for n in (1, 1, 2, 2, 3, 9, 10, 11, 12, 13, 14, 15, 16, 30) for _ in range(4)}
    words = {"zz", "q", "é"}
    for w in known:
        for _ in range(6):
            x = list(w)
            for _ in range(int(rng.integers(0, 4))):
                at, kind = int(rng.integers(0, len(x) + 1)), int(rng.integers(0, 3))
                x = x[:at] + ([] if kind == 0 else [str(rng.choice(list("abcé")))]) + x[at + (kind != 1) :]
            if x:
                words.add("".join(x))
    vocab = {w: 1 + k % 3 for k, w in enumerate(sorted(known))}

    got = lexicon.spell_suggestions(
        spark.createDataFrame([(w,) for w in sorted(words)], "word string").repartition(3),
        spark.createDataFrame(list(vocab.items()), "word string, freq long"),
    ).collect()
    assert len(got) == len(words - known)
    for r in got:
        best = min((lev(r.word, v), -f, v) for v, f in vocab.items())
        want = (best[2], best[0], -best[1]) if best[0] <= 2 else (r.word, None, None)
        assert (r.suggestion, r.distance, r.freq) == want


def test_verb_noun_counts_beyond_a_broadcast(spark):
    rows = [(1, ["run", "run", "dog", "zz"]), (2, []), (3, None), (4, ["dog"] * 5 + ["run"])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    lex = spark.createDataFrame([("run", "VB"), ("dog", "NN")], "token string, tag string")
    got = {tuple(r) for r in lexicon.verb_noun_counts(df, lex, broadcast_bytes=0).collect()}
    assert got == {(1, 2, 1), (2, 0, 0), (3, 0, 0), (4, 1, 5)}


def test_narrow_stages_move_no_text(spark, monkeypatch):
    """The result of a content is computed where its rows are, copies included, and texts stay out of the joins of keyed frames."""
    from pyspark.ml import PipelineModel

    from msgtriage.operators import table_models as T
    from msgtriage.session import materialize

    rows = [(1, "Walk home. See cats", ["walk", "home", "see", "cats"]), (2, "Walk home. See cats", ["walk", "home", "see", "cats"]), (3, None, None), (4, "", []), (5, "cats", ["cats"])]
    rows = [(i, m, t, [{"walk": "VB", "see": "VB", "home": "NN", "cats": "JJ"}[x] for x in t or ()], [("home see", "GPE"), ("home", "PERSON"), ("cats", "GPE")]) for i, m, t in rows]
    corpus = spark.createDataFrame(rows, "id int, message string, tokens array<string>, tags array<string>, entities array<struct<phrase string, type string>>").repartition(4)
    model = PipelineModel(stages=[s.fit(corpus) for s in (T.GetVerbNounCount(outputCol="vn"), T.StartingVerbExtractor(), T.EntityCount())])
    plans, kept = [], T.materialize
    monkeypatch.setattr(T, "materialize", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or kept(df, name))
    monkeypatch.setattr(T.lexicon, "sized_side", lambda df, *_: df)  # joins by shuffle
    plain = model.transform(corpus)
    assert len(plans) == 3 and not any(f"first({c}" in p for p in plans for c in ("tokens", "message"))
    want = {1: ([2.0, 1.0], True, 1.0, 0.0), 2: ([2.0, 1.0], True, 1.0, 0.0), 3: ([0.0, 0.0], False, 0.0, 0.0), 4: ([0.0, 0.0], False, 0.0, 0.0), 5: ([0.0, 0.0], False, 1.0, 0.0)}
    keyed = materialize(T.with_content_keys(corpus, model.stages), "keyed")
    for found in (plain, model.transform(keyed)):
        found = found.select("id", "vn", "starting_verb", *T.entity_names(F.col("entities_found")))
        assert {r.id: (r.vn.toArray().tolist(), r.starting_verb, r.GPE, r.PERSON) for r in found.collect()} == want
    read = [line for line in found._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line and "_key_" in line]
    assert read and not any("tokens" in line or "message" in line for line in read)
