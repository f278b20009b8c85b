"""N-gram join, decontamination and personal data against brute force."""

import hashlib
import random
import time

import pytest
from brute import ALNUM, LOWER, base_spans, components, decontamination
from pyspark.sql import functions as F

from msgtriage.llm import decontaminate, ngram_join, pii

WORDS = "the of and in to é ñandú Straße was that 42 x".split()


def prose(rng, n, extra=()):
    return " ".join(rng.choice([*WORDS, *extra, f"w{rng.randrange(300)}"]) for _ in range(n))


def near_copies():
    rng = random.Random(3)
    rows = [(None, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "ONE  two"), (5, "one two three"), (6, " ")]
    line, ids = prose(rng, 30), iter(rng.sample(range(100, 9000), 300))
    for g in range(12):  # groups whose members differ in 0 to 8 places, all with one common line
        base = (line + "\n" + prose(rng, 80)).split(" ")
        for _ in range(15):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append((next(ids), " ".join(w)))
    rows += [(9001, prose(rng, 20000)), (None, rows[-1][1]), (rows[-2][0], rows[-2][1]), (rows[-2][0], rows[-2][1])]
    return rows


@pytest.mark.parametrize("tree_rows, chunk_tokens", [(2048, 1 << 22), (16, 1 << 22), (2048, 700)])
def test_components_equal_all_pairs(spark, monkeypatch, tree_rows, chunk_tokens):
    monkeypatch.setattr(ngram_join, "CHUNK_TOKENS", chunk_tokens)
    rows = near_copies()
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, set_id string, n int").repartition(3)
    got = [tuple(r) for r in ngram_join.jaccard_components(docs, tree_rows=tree_rows).collect()]
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=order) == sorted(components(rows), key=order)


def test_keep_one_per_group(spark):
    rows = near_copies()
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, group int").repartition(3)
    kept = ngram_join.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    found = components(rows)
    wanted = {c for _, n, c in found if n} | {None}
    got = kept.collect()
    assert sum(r.doc_id in (None, 1, 2, 6) for r in got) == 4  # texts without words all stay (one is U+00A0, a word)
    with_words = [r for r in got if r.text and r.text.strip(" \t\n")]
    assert sorted(r.doc_id for r in with_words) == sorted(c for c in wanted if c is not None)


def test_join_on_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.jaccard_components(docs).collect() == []
    assert ngram_join.keep_one_per_group(docs).collect() == []


def test_links_of_a_block_are_a_forest():
    import numpy as np

    base = np.arange(1, 101, dtype=np.uint64)
    sets = [np.unique(np.append(base[k:], 1000 + k).astype(np.uint64)) for k in range(30)] + [base + np.uint64(10**6)]
    off = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    i, j = np.triu_indices(len(sets), 1)
    links = ngram_join._joining_links(iter([(i, j)]), np.concatenate(sets), off, np.arange(len(sets)), 80)
    assert len(links) == 29 and all(x < 30 and y < 30 for x, y in links)
    for x, y in links:
        a, b = set(sets[x].tolist()), set(sets[y].tolist())
        assert 100 * len(a & b) >= 80 * len(a | b)


def test_signature_bounds_never_exclude_links():
    import numpy as np

    rng = np.random.RandomState(5)
    for n in (1, 3, 40, 700):
        base = rng.randint(0, 2**62, n).astype(np.uint64)
        sets = [np.unique(np.concatenate([base[rng.rand(n) < 0.95], rng.randint(0, 2**62, max(1, n // 20)).astype(np.uint64)])) for _ in range(30)]
        size = np.array([len(s) for s in sets])
        order = np.argsort(size, kind="stable")
        raw = [ngram_join.bitmap(sets[k]).tobytes() for k in order]
        words = max(map(len, raw)) // 8
        bits = np.stack([ngram_join._widened(r, words) for r in raw])
        spare = size[order] - np.array([np.bitwise_count(np.frombuffer(r, np.uint64)).sum() for r in raw]).astype(np.int64)
        tree = ngram_join.SignatureTree(size[order], bits, spare, np.full(len(sets), 10**6))
        got = {(i, j) for a, b in ngram_join.dual_traversal(tree, tree, 80) for i, j in zip(a.tolist(), b.tolist())}
        for i in range(len(sets)):
            for j in range(i + 1, len(sets)):
                a, b = set(sets[order[i]].tolist()), set(sets[order[j]].tolist())
                if 100 * len(a & b) >= 80 * len(a | b):
                    assert (i, j) in got


def contaminated(rng):
    items = [(k, prose(rng, rng.choice([0, 1, 3, 9, 10, 14, 40]), ("é",))) for k in range(40)] + [(3, "repeated id with other words"), (None, "words without any id"), (50, None), (51, "...")]
    docs = [(None, None), (1, ""), (2, "...")]
    for k in range(80):
        parts = [prose(rng, rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            w = ALNUM.findall(rng.choice(items)[1] or "")
            cut = rng.randrange(len(w) + 1)
            parts += [", ".join(w[cut : cut + rng.randrange(30)]).upper(), prose(rng, 5)]
        docs.append((k % 70, " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("block_words", [500_000, 30])
def test_decontamination_equals_brute_force(spark, block_words):
    docs, items = contaminated(random.Random(8))
    d = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, spans string")
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, words int")
    got = [tuple(r)[:6] for r in decontaminate.report(decontaminate.scan(d, b, block_words=block_words)).collect()]
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=order) == sorted(decontamination(docs, items), key=order)


def test_cleaning_does_not_depend_on_blocks(spark):
    docs, items = contaminated(random.Random(10))
    first, second = ([f"{c}{k}" for k in range(20)] for c in "gh")
    items += [("90", " ".join(first)), ("91", " ".join(second))]  # ids far apart: blocks of their own
    rest = [f"r{k}" for k in range(26)]
    docs += [(900, " ".join([*first, *rest, *second])), (901, " ".join([*first[:9], *second, *first[9:18], *rest, *rest]))]
    d = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(docs)], "doc_id long, text string, spans int").repartition(3)
    b = spark.createDataFrame([(None if i is None else str(i), t) for i, t in items], "item_id string, text string")
    for most in (0.5, 1.1):
        whole, blocks = (decontaminate.decontaminate(d, b, max_coverage=most, block_words=n) for n in (500_000, 30))
        assert blocks.columns == d.columns
        assert sorted(map(tuple, blocks.collect()), key=lambda r: r[2]) == sorted(map(tuple, whole.collect()), key=lambda r: r[2])
    left = {r.doc_id: r.text for r in blocks.collect()}  # every text stays at 1.1
    assert "h0" not in left[900] and left[901].split() == [*rest, *rest]


def test_cut_texts_hold_no_window(spark):
    docs, items = contaminated(random.Random(9))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.decontaminate(d, b, max_coverage=1.1)
    assert out.count() == len(docs) and out.columns == d.columns
    assert not any(r[5] for r in decontamination([tuple(r) for r in out.collect()], items))
    clean = {(i, t) for (i, t), r in zip(docs, decontamination(docs, items)) if not r[5]}
    assert clean <= {tuple(r) for r in decontaminate.decontaminate(d, b).collect()}


def test_decontamination_of_nothing(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    row = decontaminate.report(decontaminate.scan(d, none)).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)
    assert decontaminate.decontaminate(d, none).collect() == d.collect()
    assert decontaminate.scan(d.limit(0), d.withColumnRenamed("doc_id", "item_id")).collect() == []


PII_TEXTS = [
    None, "", "a@b.c@d.e", "a@b.cd%x@e.f x@y a@b..c a@b.c..d@e.f -a@b.c. é@é.fr a.b@c-d.e.f,", "%\\G@a.b\n@@a@b.c",
    "1.2.3.4.5.6.7.8 300.1.1.1 01.002.0003.255 1.2.3 1..2.3.4 256.1.1.1.1.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 x4111111111111111x 4111  1111 1111 1111 1- 2 3 4111111111111111-",
    "+1 (988) 555-2485 ++1 22 3333 444 +12345678 +1234567 + 12345678 +1(((((((2345678 +1 555 555 5555 +1 555.555.5555",
    "😀 a@b.co 😀 4111111111111111 😀 +1 988 555 2485", "x" * 30000, "1 " * 5000, "1" * 8000, "a@b" + ".c" * 6000, "a@b.c " * 300, "a.b-c+d%e_f" * 2000 + "@x.y",
]


def test_base_spans_equal_plain_patterns(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(PII_TEXTS)], "doc_id int, text string, spans string").withColumn("doc_id", F.col("doc_id").cast("long"))
    with pytest.raises(ValueError):
        pii.find(docs)
    for r in pii.report(pii.find(docs.drop("spans"))).collect():
        base = base_spans(PII_TEXTS[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), r.doc_id
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in base) for k in ("email", "ip", "card", "phone")]
        assert set(joined.split(",")) <= set(r.spans.split(","))


def test_added_rules_and_redaction(spark):
    texts = [
        "IBAN DE89370400440532013000 and GB82 WEST 1234 5698 7654 32 not DE89370400440532013001",
        "card 378282246310005 ssn 123-45-6789 call (555) 123-4567 or 555-123-4567",
        "378282246310005 123-45-6789 (555) 123-4567",  # no context word
        "+1 (269) 555-3296 4111111111111111 38.253.197.126", None, "",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.text for r in pii.redact(docs).orderBy("doc_id").collect()]
    assert got == [
        "IBAN <IBAN> and <IBAN> not DE89370400440532013001", "card <CARD> ssn <SSN> call <PHONE> or <PHONE>",
        "378282246310005 123-45-6789 (555) 123-4567", "<PHONE> <CARD> <IP>", None, "",
    ]
    assert pii.redact(docs.limit(0)).collect() == []


def test_redaction_keeps_clashing_columns(spark):
    names = ["spans", "__pii", "__at", "__parts", "__kept", "__base", "__spans", "__reach"]
    docs = spark.createDataFrame([(1, "a@b.cd x 1.2.3.4", *names)], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.first()[1:] == ("<EMAIL> x <IP>", *names)
    found = pii.find(docs, name="found").first()
    assert found.spans == "spans" and [s.kind for s in found.found] == ["email", "ip"]


def test_texts_with_very_many_spans(spark):
    rng = random.Random(4)
    lines = [rng.choice([f"{rng.randrange(300)}.{rng.randrange(256)}.7.1", "4111 1111 1111 1111", "é😀 card 378282246310005", "a@b.co", "+1 988 555 2485 "]) for _ in range(40000)]
    text = "\n".join(lines)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    started = time.monotonic()
    found = pii.find(docs).first().spans
    base = [(s.kind, s.first, s.end) for s in found if s.rule in pii.BASE]
    assert base == base_spans(text)
    assert all(text[s.first : s.end] == s.value for s in found)
    taken = [(s.first, s.end) for s in found if s.rule in pii.BASE]
    extra = [(s.first, s.end) for s in found if s.rule not in pii.BASE]
    covered = bytearray(len(text))
    for a, b in taken:
        covered[a:b] = b"\1" * (b - a)
    assert extra and not any(any(covered[a:b]) for a, b in extra)
    out, at = [], 0
    for s in sorted(found, key=lambda s: (s.first, -s.end)):
        if s.first >= at:
            out += [text[at : s.first], f"<{s.kind.upper()}>"]
        at = max(at, s.end)
    assert pii.redact(docs).first().text == "".join([*out, text[at:]])
    assert time.monotonic() - started < 120


def test_lower_table_matches_contract():
    assert "ÀZ".translate(LOWER) == "Àz"
