"""Merkle manifest, Hilbert shards and tokenizer alignment against brute force."""

import hashlib
import itertools
import random
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from msgtriage.llm import crosstok, hilbert, merkle, order

FILES = ("/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model")
SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row, text):
    values = [row[0], row[1], row[2], row[3], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(leaves, arity):
    """Top of the leaves and per leaf the (left, right) siblings of it and its ancestors."""
    paths, at, row = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(row) > 1:
        for k in range(len(leaves)):
            first = at[k] // arity * arity
            paths[k].append((row[first : at[k]], row[at[k] + 1 : first + arity]))
            at[k] //= arity
        row = [sha("".join(row[i : i + arity])) for i in range(0, len(row), arity)]
    return row[0], paths


def merkle_rows(rows, arity=3):
    trees = defaultdict(list)
    for r in rows:
        trees[(r[1] is not None, (r[1] or "").encode())].append(r)
    found = []
    for name in sorted(trees):
        own = sorted(trees[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
        found.append((own, *climb([leaf_of(r, r[4]) for r in own], arity)))
    if not found:
        return Counter()
    root, upper = climb([top for _, top, _ in found], arity)
    out = Counter()
    for (own, top, paths), above in zip(found, upper):
        for r, path in zip(own, paths):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            d = leaf_of(r, r[4].replace("\n", "") if tampered else r[4])
            for left, right in path + above:
                d = sha("".join([*left, d, *right]))
            proof = sha("".join("".join(left + right) for left, right in path + above))
            out[(r[0], leaf_of(r, r[4]), top, root, proof, d, d == root)] += 1
    return out


def merkle_corpus():
    rng = random.Random(5)
    rows = [(i, "big", "en", i, rng.choice(["a\nb", "a b", "", "ü\n\n", None]) or None) for i in range(300)]
    for source, n in (("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 27), ("f", 28), ("g", 82), ("", 9), (None, 10), ("Ü", 81), ("-", 5)):
        rows += [(rng.randrange(10**6), source, rng.choice(["en", None, ""]), rng.choice([None, 3]), "t\n%d" % rng.randrange(9)) for _ in range(n)]
    rows += [(7, "big", "en", 1, "x\ny")] * 40 + [(None, "big", None, None, None)] * 3 + [(None, "big", None, None, "z\n"), (-5, "f", "de", 2, "\n")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("levels", [4, 2])
def test_merkle_equals_brute_force(spark, levels):
    rows = merkle_corpus()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("path", F.lit(1)).withColumn("item", F.lit("x")).repartition(5)
    trees = merkle.manifest(docs, {"copy": F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, merkle.leaf_digest(F.replace("text", F.lit("\n"), F.lit(""))))}, levels=levels)
    out = trees.proofs().select(
        "item.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("p"), merkle.fold(F.coalesce("item.copy", "leaf"), F.col("path")).alias("f")
    )
    got = Counter((*r, r.f == r.root) for r in out.collect())
    assert got == merkle_rows(rows)
    if levels == 4:
        tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
        assert Counter(map(tuple, merkle.verify(docs, tampered, F.replace("text", F.lit("\n"), F.lit(""))).collect())) == got


def test_merkle_nodes_are_nested_intervals(spark):
    rows = merkle_corpus()
    trees = merkle.manifest(spark.createDataFrame(rows, SCHEMA), {})
    nodes = trees.nodes().collect()
    by = defaultdict(dict)
    for r in nodes:
        assert (r.lo, r.hi) not in by[(r.tree, r.level)]
        by[(r.tree, r.level)][(r.lo, r.hi)] = r.digest
    for tree in {r.tree for r in nodes}:
        n = next(r.leaves for r in nodes if r.tree == tree)
        level, row = 0, [by[(tree, 0)][(i, i + 1)] for i in range(n)]
        while True:
            wide = 3**level
            assert [by[(tree, level)][(i * wide, min((i + 1) * wide, n))] for i in range(len(row))] == row
            if len(row) == 1:
                break
            row, level = [sha("".join(row[i : i + 3])) for i in range(0, len(row), 3)], level + 1
        assert (tree, level + 1) not in by


def test_merkle_of_no_rows_and_one_row(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert merkle.verify(docs, F.lit(True), F.col("text")).collect() == []
    row = (3, None, None, None, None)
    one = spark.createDataFrame([row], SCHEMA)
    leaf = leaf_of(row, None)
    assert [tuple(r) for r in merkle.verify(one, F.lit(True), F.lit("other")).collect()][0][:5] == (3, leaf, leaf, leaf, sha(""))
    assert not merkle.verify(one, F.lit(True), F.lit("other")).first().verified


def test_numbered_splits_equal_rows(spark):
    rows = [("same",)] * 25_000 + [(f"k{i:05}",) for i in range(5_000)] + [(None,)]
    df = spark.createDataFrame(rows, "k string").withColumn("at", F.lit(1)).repartition(3)
    got = order.numbered(df, [F.col("k").asc_nulls_first()], "place", "test-order")
    assert got.columns == ["k", "at", "place"]
    seen = sorted((r.place, r.k) for r in got.collect())
    assert [p for p, _ in seen] == list(range(len(rows)))
    assert [k for _, k in seen] == [None] + sorted(k for (k,) in rows if k)
    stored = order.ranged(df, [F.col("k")], "at_", "test-ranged")
    assert stored.where("k = 'same'").select("at_.part").distinct().count() > 1


# --------------------------------------------------------------------------- shards


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 3), (4, 2), (5, 1)])
def test_curve_visits_neighbours(spark, n, bits):
    cells = list(itertools.product(range(1 << bits), repeat=n))
    df = spark.createDataFrame(cells, ", ".join(f"c{i} int" for i in range(n)))
    got = df.select(hilbert.curve_index([F.col(f"c{i}") for i in range(n)], bits).alias("h"), F.array(*df.columns).alias("c")).collect()
    along = [r.c for r in sorted(got, key=lambda r: r.h)]
    assert sorted(r.h for r in got) == list(range(len(cells)))
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(along, along[1:]))


def shard_corpus():
    rng = random.Random(8)
    rows = [(i, rng.choice(["hot", "hot", "b", "c", None]), rng.choice(["en", "de"]), rng.choice(["x", "ü" * rng.randrange(60), None, ""])) for i in range(400)]
    return rows + [(5, "hot", "en", "copy")] * 200 + [(None, None, None, None)] * 5


def brute_shards(rows, shards, bits):
    """(doc_id, size, crc, curve, shard, slot) with an own walk along the curve."""
    table = hilbert.curve_table(3)
    rank = []
    for c in (1, 2):
        names = sorted({r[c] for r in rows}, key=lambda v: (v is not None, v or ""))
        rank.append({v: k * (1 << bits) // len(names) for k, v in enumerate(names)})
    import math

    size = [len((r[3] or "").encode()) + 8 for r in rows]
    low, high = math.log1p(min(size)), math.log1p(max(size))
    out = []
    for r, z in zip(rows, size):
        cell = [rank[0][r[1]], rank[1][r[2]], min(int((math.log1p(z) - low) / ((high - low) or 1) * (1 << bits)), (1 << bits) - 1)]
        index, state = 0, 0
        for b in range(bits - 1, -1, -1):
            entry = table[state << 3 | sum((x >> b & 1) << j for j, x in enumerate(cell))]
            index, state = index << 3 | entry >> 8, entry & 255
        crc = zlib.crc32((r[3] or "").encode())
        out.append((index, crc, r[0] is not None, r[0] or 0, r[0], z))
    out.sort(key=lambda x: x[:4])
    bounds = [-(-s * len(out) // shards) for s in range(shards + 1)]
    rows = []
    for p, (index, crc, _, _, doc_id, z) in enumerate(out):
        s = p * shards // len(out)
        rows.append((doc_id, z, crc, index, s, p - bounds[s]))
    return rows


@pytest.mark.parametrize("shards", [24, 7, 1000])
def test_shards_equal_brute_force(spark, shards):
    rows = shard_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").withColumn("place", F.lit(0)).withColumn("source_step", F.lit(0)).repartition(4)
    out = hilbert.assign(hilbert.measured(docs), ties=("text_crc32", "doc_id"), shards=shards)
    assert out.columns == [*docs.columns, "size", "text_crc32", "curve", "shard", "slot"]
    got = Counter(tuple(r) for r in out.select("doc_id", "size", "text_crc32", "curve", "shard", "slot").collect())
    assert got == Counter(brute_shards(rows, shards, hilbert.BITS))
    counts = Counter(k[4] for k in got.elements())
    used = [counts.get(s, 0) for s in range(shards)]
    assert max(used) - min(used) <= 1
    if shards == 24:
        again = hilbert.assign(hilbert.measured(docs.repartition(2)), ties=("text_crc32", "doc_id"), shards=shards)
        assert Counter(tuple(r) for r in again.select("doc_id", "size", "text_crc32", "curve", "shard", "slot").collect()) == got


def test_zones_prune_in_every_dimension(spark):
    rng = random.Random(4)
    rows = [(i, f"s{rng.randrange(32):02}", rng.randrange(1000), int(10 ** (rng.random() * 4))) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, day int, size long")
    dims = (("source", "category"), ("day", "linear"), ("size", "log"))
    zones = hilbert.zones(hilbert.assign(docs, dims, ties=("doc_id",), shards=64), ["source", "day", "size"])
    assert zones.agg(F.sum("rows")).first()[0] == len(rows) and zones.count() == 64
    touched = {
        "source": zones.where("source_min <= 's07' and source_max >= 's07'").count(),
        "day": zones.where("day_min <= 500 and day_max >= 500").count(),
        "size": zones.where("size_min <= 100 and size_max >= 100").count(),
    }
    assert max(touched.values()) <= 32, touched  # rows in id order would touch all 64


def test_shards_of_odd_values_and_no_rows(spark):
    docs = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, None), (4, float("-inf")), (5, 2.5), (6, -1.0)], "doc_id long, x double")
    got = hilbert.assign(docs, (("x", "linear"), ("doc_id", "linear")), ties=("doc_id",), shards=2, bits=1).collect()
    assert Counter(r.shard for r in got) == {0: 3, 1: 3}
    steps = {r.doc_id: r.curve for r in got}
    assert steps[1] == steps[3] == 0 and steps[4] == steps[6] != 0 and len({steps[i] for i in (1, 2, 4, 5)}) == 4
    assert hilbert.assign(docs.limit(0), (("x", "log"), ("doc_id", "category"))).collect() == []
    with pytest.raises(ValueError):
        hilbert.assign(docs, (("x", "linear"), ("doc_id", "other")))


def test_measured_is_of_utf8_bytes(spark):
    rows = hilbert.measured(spark.createDataFrame([(1, "aü😀"), (2, ""), (3, None)], "doc_id long, text string")).collect()
    assert [(r.size, r.text_crc32) for r in rows] == [(15, zlib.crc32("aü😀".encode())), (8, 0), (8, 0)]


# --------------------------------------------------------------------------- tokens


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def brute_alignment(rows, a, b):
    of_char = crosstok.byte_of_char()
    name = {i: t for t, i in a.get_vocab().items()}
    links, found = Counter(), []
    for doc_id, text in rows:
        ids = [a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")] if text else [[], []]
        spelled = [[bytes(of_char[c] for c in name[i]) for i in ids[0]], []]
        for i in ids[1]:
            piece = b.id_to_piece(i)
            spelled[1].append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        if not text or any(b"".join(s) != (" " + text).encode() for s in spelled):
            found.append((doc_id, 0, 0, [], ""))
            continue
        ends = [list(itertools.accumulate(map(len, s))) for s in spelled]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, at = [], [0, 0]
        for end in common:
            stop = [bisect_left(ends[s], end) + 1 for s in (0, 1)]
            groups.append(tuple(ids[s][at[s] : stop[s]] for s in (0, 1)))
            at = stop
        own = [(x[-1], y[-1]) for x, y in groups]
        links.update(own)
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        found.append((doc_id, len(ids[0]), len(ids[1]), own, hashlib.sha256(text.encode()).hexdigest()))
    best = {}
    for (_, y), n in links.items():
        best[y] = max(best.get(y, 0), n)
    return Counter((d, na, nb, len(own), len(own), sum(links[p] == best[p[1]] for p in own), sum(links[p] for p in own), h) for d, na, nb, own, h in found), links


ODD = [
    None, "", " ", "  x", "\n", "a\n\n  b", "<|endoftext|>", "<s></s><unk><0x41>", "▁", "a▁b", "naïve café", "日本語のテキスト", "😀👩‍👩‍👧", "\x00a\x00", "﻿x", "á b",
    "1234567890 12", "don't we'll I'd", "x" * 3000, "½ a ½ Ⅷ b", "tab\tand\r\nmore", " nbsp em", "ﬁ ﷺ", "العربية", "𐍈 𝔘𝔫𝔦", "a  b   c    d", "?!... ,,,", "\U0010ffff",
]


def test_alignment_equals_brute_force(spark, tokenizers, monkeypatch):
    rng = random.Random(3)
    words = ["the", "of", "cat", "Straße", "über", "été", "xqzjv", "123", "it's", "e-mail", "日本"]
    texts = ODD + [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    texts += [" ".join(rng.choice(words[:6]) for _ in range(30_000)), "y" * 60_000, "7 " * 30_000, " " * 50_000 + "z"] + ["same text here"] * 30
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "again"), (3, "again"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash")).withColumn("pairs", F.lit(1)).repartition(3)
    files = crosstok.read_vocabularies(*FILES)
    aligned = crosstok.align(docs, *files)
    b_size = crosstok.piece_count(files[1])
    counts = crosstok.pair_counts(aligned, b_size)
    want, links = brute_alignment(rows, *tokenizers)
    assert {(r.a_id, r.b_id): r["count"] for r in counts.collect()} == dict(links)
    assert Counter(map(tuple, crosstok.report(aligned, counts).collect())) == want
    monkeypatch.setattr(crosstok, "BROADCAST_PAIRS", 0)
    assert Counter(map(tuple, crosstok.report(aligned, counts).collect())) == want


def test_slices_do_not_change_the_alignment(tokenizers, monkeypatch):
    import pyarrow as pa

    class Shared:
        value = (*crosstok.read_vocabularies(*FILES), crosstok.Tokens(*crosstok.read_vocabularies(*FILES)))

    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "beta,", "γάμμα", "12", "don't"]) for _ in range(2000))
    batch = pa.record_batch({"row": pa.array([0, 1, 2, 3]), "doc_id": pa.array([9, 8, 7, 6]), "text": pa.array([text, None, "a▁b " + text, "short"])})
    whole = [r for b in crosstok._align([batch], Shared) for r in b.to_pylist()]
    monkeypatch.setattr(crosstok, "PIECE_CHARS", 50)
    monkeypatch.setattr(crosstok, "SLICE_CHARS", 300)
    assert [r for b in crosstok._align([batch], Shared) for r in b.to_pylist()] == whole
    assert whole[2]["n_a"] == 0 and whole[2]["groups_sha256"] == "" and whole[0]["n_groups"] > 1000


def test_repeated_parts_are_tokenized_once(tokenizers, monkeypatch):
    files = crosstok.read_vocabularies(*FILES)
    v = crosstok.Vocabularies(*files, crosstok.Tokens(*files))
    a, b = tokenizers
    seen = []

    class Spy:
        def encode_batch_fast(self, texts, **settings):
            seen.extend(texts)
            return a.encode_batch_fast(texts, **settings)

    v.a = Spy()
    odd = [t for t in ODD if t] + ["it's 12 naïve, cats\x1c x\x1c y  z \u2028 w"]
    texts = ["the cat, of 12 words. " * 500 + "end"] * 20 + odd + [x + " " + y for x in odd for y in odd]

    def check():
        for lo in range(0, len(texts), 100):  # slice by slice
            own = texts[lo : lo + 100]
            wanted = [a.encode(" " + t, add_special_tokens=False).ids for t in own], [b.encode(t) for t in own]
            for (ids, counts), want in zip(v.encode([" " + t for t in own]), wanted):
                assert counts.tolist() == [len(x) for x in want] and ids.tolist() == list(itertools.chain.from_iterable(want))

    check()
    assert sum(map(len, seen)) < sum(map(len, texts)) / 5
    seen.clear()
    v.encode([" " + t for t in texts])
    assert seen == []  # kept from slice to slice
    monkeypatch.setattr(crosstok, "KEPT_CHARS", 0)
    check()
    assert v.kept_chars <= sum(map(len, texts[-100:])) and seen


def test_terminals_follow_chains():
    import numpy as np

    a, b = np.array([3, 6, 9, 12, 14]), np.array([1, 4, 7, 10, 12, 14])
    assert crosstok.terminals(a, b).tolist() == [3, 3, 3, 3, 4, 3, 3, 3, 3, 3, 4]
    long_a, long_b = np.arange(2, 100_002, 2), np.append(np.arange(1, 100_000, 2), 100_000)
    assert set(crosstok.terminals(long_a, long_b)) == {len(long_a) - 1}


def test_alignment_of_no_rows(spark):
    files = crosstok.read_vocabularies(*FILES)
    aligned = crosstok.align(spark.createDataFrame([], "doc_id long, text string"), *files)
    assert crosstok.report(aligned, crosstok.pair_counts(aligned, 32000)).collect() == []
