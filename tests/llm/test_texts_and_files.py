"""Language ID, quality, web pages, archives and token files."""

import gzip
import hashlib
import io
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from msgtriage.llm import html_text, langid, nbsvm, token_files, warc
from msgtriage.session import scratch_path

# -- language ID ---------------------------------------------------------------


def test_forward_sums_all_segmentations():
    pieces = sorted(["▁", "▁a", "a", "b", "ab", "▁ab", "aba", "c", "ca"])
    table = langid.PieceTable(pieces)
    prob = np.random.RandomState(1).rand(len(pieces), 2)
    words = ["a", "ab", "aba", "abab", "cab", "abaca", "xa"]
    got = langid.word_scores(table, prob, words)
    for w, row in zip(words, got):
        marked = langid.MARK + w
        for lang in range(2):
            total = 0.0
            for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
                parts, at = [], 0
                for k, cut in enumerate(cuts, 1):
                    if cut:
                        parts.append(marked[at:k])
                        at = k
                parts.append(marked[at:])
                p = 1.0
                for k, x in enumerate(parts):
                    own = prob[pieces.index(x), lang] if x in pieces else 0.0
                    free = (1.0 if k == 0 else langid.FLOOR) if len(x) == 1 else 0.0  # one letter without a piece
                    p *= own + free
                total += p
            assert math.isclose(math.exp(row[lang]), total, rel_tol=1e-9)


def test_expected_counts_add_up():
    pieces = sorted(["▁", "a", "b", "ab", "ba", "▁a"])
    table, prob = langid.PieceTable(pieces), np.full((6, 1), 1 / 6)
    total = langid.expected_counts(table, prob, ["ab", "bab"], np.array([0, 0]), np.array([2, 3]))
    letters = sum(total[k, 0] * len(p.removeprefix("▁")) for k, p in enumerate(pieces))
    assert math.isclose(letters, 2 * 2 + 3 * 3, rel_tol=1e-4)  # but for letters taken as rare pieces


def language_rows(rng, n):
    words = {"x1": ["the", "house", "water", "under", "thing"], "x2": ["maison", "bonjour", "eau", "rue", "étage"], "x3": ["straße", "haus", "wasser", "unter", "ding"]}
    return [(k, lang := rng.choice(sorted(words)), " ".join(rng.choice(words[lang]) + rng.choice(["", "s", "er"]) for _ in range(rng.randrange(3, 30)))) for k in range(n)]


@pytest.fixture(scope="module")
def pieces():
    return langid.vocabulary_pieces("/opt/tokenizers/piece_bpe_32k.model")


def test_language_prediction(spark, pieces):
    rows = language_rows(random.Random(1), 240)
    train = spark.createDataFrame([(t, lang) for _, lang, t in rows[:120]] + [("no language", None), (None, "x1")], "text string, lang string")
    model = langid.fit(train, pieces, max_rows=50)
    odd = [(900, None), (901, ""), (902, "123 ... \n"), (903, "water " * 20000), (904, "straße" * 5000), (905, "漢字")]
    docs = spark.createDataFrame([(k, t, "score") for k, _, t in rows[120:]] + [(k, t, "score") for k, t in odd], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert len(got) == 126 and all(0.0 <= r.score <= 1.0 for r in got.values())
    assert sum(got[k].lang_pred == lang for k, lang, _ in rows[120:]) >= 118
    assert [got[k].lang_pred for k in (900, 901, 902, 903, 904)] == ["und", "und", "und", "x1", "x3"]
    assert got[905].lang_pred in model.langs
    with pytest.raises(ValueError):
        langid.predict(docs, model, names=("lang", "p"))


def test_language_without_training(spark, pieces):
    none = spark.createDataFrame([], "text string, lang string")
    model = langid.fit(none, pieces)
    assert [tuple(r)[1:] for r in langid.predict(spark.createDataFrame([("water",)], "text string"), model).collect()] == [("und", 0.0)]


# -- quality -------------------------------------------------------------------


def quality_rows(rng, n):
    out = []
    for k in range(n):
        words = [rng.choice("the of and house water under thing was".split()) for _ in range(rng.randrange(5, 60))]
        good = k % 4 > 0
        out.append((k, " ".join(words) if good else rng.choice([" ".join(w.upper() + "!!" for w in words), " ".join([words[0]] * 30), "$$$".join(words)]), int(good)))
    return out


def test_quality(spark):
    rows = quality_rows(random.Random(3), 400)
    train = spark.createDataFrame([r[1:] for r in rows[:250]] + [(rows[0][1], rows[0][2]), ("a b", None), (None, 1)], "text string, label int")
    model = nbsvm.fit(train, blocks=3)
    docs = spark.createDataFrame([(k, t, y) for k, t, y in rows[250:]] + [(900, None, 1), (901, "", 1), (902, "the water " * 30000, 1)], "doc_id long, text string, predicted int")
    got = {r.doc_id: r.score for r in nbsvm.score(docs, model).collect()}
    assert len(got) == 153 and all(0.0 <= s <= 1.0 for s in got.values())
    assert sum((got[k] >= 0.5) == (y == 1) for k, _, y in rows[250:]) >= 145
    assert got[900] == got[901]
    one_class = nbsvm.fit(train.where("label = 1"))
    assert {r.score for r in nbsvm.score(docs, one_class).collect()} == {0.5}
    assert nbsvm.score(docs.limit(0), model).collect() == []


def test_indicators_are_distinct_and_local():
    import pyarrow as pa

    texts = ["a b a b", None, "", "a b a b", "x" * 100, "The the THE"]
    rows = [np.sort(x) for x in nbsvm.indicators(pa.array(texts))]
    assert len(rows) == 6 and (rows[0] == rows[3]).all() and not len(rows[1]) and not len(rows[2])
    assert all(len(np.unique(x)) == len(x) for x in rows)
    alone = [np.sort(next(nbsvm.indicators(pa.array([t], pa.string())))) for t in texts]
    assert all((a == b).all() for a, b in zip(rows, alone) if len(a) == len(b)) and [len(a) for a in alone] == [len(a) for a in rows]


# -- web pages -----------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><div>Site</div><nav><a href=/>Home</a></nav></header>
<div class="cookie-notice">We use cookies to make this site better for you and all others, accept?</div>
<div id=wrap><div class="sidebar"><p>Popular posts that you may like to read today in full length</p></div>
%s<h1>Title &amp; more</h1><p>First paragraph with a lot of text, that is quite long and has <a href=x>one link</a> inside of it &eacute;&nbsp;x.
<p>Short.</p><p><b>Another rather long paragraph follows here, as articles have several of those,<br>and they are long.</p>
<ul><li>item one</li><li>item &#50;</li></ul>%s
<div class="comments"><p>Great article, I loved reading every single word of it, thanks a lot to the author!</p></div></div>
<form><p>Search the whole site for something</p></form><footer>&copy; 2024 site</footer>"""
TEXT = "\n\n".join(
    [
        "Title & more", "First paragraph with a lot of text, that is quite long and has one link inside of it é x.", "Short.",
        "Another rather long paragraph follows here, as articles have several of those, and they are long.", "item one", "item 2",
    ]
)


@pytest.mark.parametrize("frame", [("<article>", "</article>"), ('<div class="content">', "</div>"), ("<main id=main><div>", "</div></main>")])
def test_article_is_found(frame):
    assert html_text.main_text(PAGE % frame) == TEXT


def prose_blocks(name, n):
    return "".join(f"<p>{name} paragraph {k} of a page whose text goes on for quite a while, as texts of articles do.</p>" for k in range(n))


def test_whole_article_without_article_element():
    page = "<body><div class=top><a href=/>Home</a> <a href=/x>News</a></div><div class=content><h1>The title of it</h1><div class=body>%s</div></div></body>"
    assert html_text.main_text(page % prose_blocks("a", 6)).startswith("The title of it\n\na paragraph 0")
    page = "<body><div><div><a href=/>Home</a></div><section>%s</section><section>%s</section></div></body>" % (prose_blocks("a", 11), prose_blocks("b", 2))
    assert html_text.main_text(page).count("paragraph") == 13


def test_every_sibling_article_stays():
    articles = [prose_blocks("a", 6), prose_blocks("b", 6), prose_blocks("c", 2)]
    page = "<body><main><p><a href=/>Home</a></p>%s<article class=comment>%s</article></main></body>"
    got = html_text.main_text(page % ("".join(f"<article>{x}</article>" for x in articles), prose_blocks("d", 2)))
    assert [sum(x.startswith(c) for x in got.split("\n\n")) for c in "abcdH"] == [6, 6, 2, 0, 0]


@pytest.mark.parametrize("tag", ['article class="post comments-open"', 'article class="no-sidebar"', 'section id="related-work"', 'div class="layout sidebar"'])
def test_misleading_names_do_not_lose_the_article(tag):
    page = f"<body><p>One stray paragraph of the page stands elsewhere, before it.</p><{tag}>{prose_blocks('a', 8)}</{tag.split()[0]}></body>"
    assert html_text.main_text(page).count("paragraph") >= 8


def test_parts_with_misleading_names_stay():
    more = "<section id=related-work>%s</section><p class=share-price>The price of a share of it rose by a good deal on that very day, as was told.</p>" % prose_blocks("r", 2)
    page = f"<body><article class='post has-comments'>{prose_blocks('a', 8)}%s{prose_blocks('b', 2)}<div class='share-buttons'>Share it with all your friends</div></article></body>"
    got = html_text.main_text(page % more)
    assert [sum(x.startswith(c) for x in got.split("\n\n")) for c in ("a ", "r ", "The price", "b ", "Share")] == [8, 2, 1, 2, 0]
    assert html_text.main_text("<p>Text <span class=ad>buy</span> goes on.</p>") == "Text goes on."


def test_html_table(spark):
    pages = [(1, PAGE % ("<article>", "</article>")), (2, None), (3, ""), (4, "plain  text"), (5, "<p>a<p>b <![foo[ x ]]> c &amp"), (6, "<" * 2000), (7, "<div>" * 3000 + "deep"), (8, "<p>" + "word " * 50000)]
    df = spark.createDataFrame([(i, "u", h, 0) for i, h in pages], "page_id long, url string, html string, kind int")
    got = {r.page_id: r for r in html_text.extract(df).collect()}
    assert got[1].text == TEXT and [got[k].text for k in (2, 3, 4, 5, 7)] == ["", "", "plain text", "a\n\nb c &", "deep"]
    assert all(r.n_chars == len(r.text) for r in got.values()) and got[8].n_chars == 249999
    assert html_text.extract(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        html_text.extract(df.withColumnRenamed("kind", "text"))


# -- archives ------------------------------------------------------------------


def test_archives_round_trip(spark):
    long_a, long_b = "a" * 1500, "é" * 500
    rows = [(1, "u1", long_a), (9, "u9", long_a), (9, "u9", long_a), (5, None, long_a), (2, "u\r\n2", long_b), (3, "u3", "short"), (4, "u4", "short"), (6, "u6", None), (7, "u7", ""), (None, "n", long_b), (None, "n", long_b), (8, "u8", "x\r\n\r\ny" * 40000)]
    pages = spark.createDataFrame([(i, u, h, "z") for i, u, h in rows], "page_id long, url string, html string, digest string").repartition(3)
    archives = warc.write_archives(pages)
    got = warc.read_archives(archives).collect()
    key = lambda i, h: (i, hashlib.sha1((h or "").encode()).hexdigest())
    assert sorted(((r.page_id, r.payload_digest) for r in got), key=str) == sorted((key(i, h) for i, _, h in rows), key=str)
    first = {long_a: 9, long_b: 2}
    for r in got:
        same = [h or "" for i, _, h in rows if key(i, h) == (r.page_id, r.payload_digest)][0]
        assert r.payload_bytes == len(same.encode())
        if r.record_type == "response":
            assert r.html == same and r.refers_to is None
        else:
            assert r.html is None and r.refers_to == first[same]
    kinds = {}
    for r in got:
        kinds.setdefault(r.payload_digest, []).append(r.record_type)
    assert sorted(map(tuple, map(sorted, kinds.values()))) == sorted(
        [("response",) + ("revisit",) * 3, ("response",) + ("revisit",) * 2, ("response",) * 2, ("response",) * 2, ("response",)]
    )
    assert {r.url for r in got if r.page_id == 2} == {"u%0D%0A2"} and {r.url for r in got if r.page_id == 5} == {None}
    assert warc.read_archives(warc.write_archives(pages.limit(0))).collect() == []


def test_reader_checks_records():
    sha1 = hashlib.sha1(b"payload").hexdigest()
    good = [warc.record_bytes(k, "u", b"payload", sha1, None, False) for k in range(50)]
    data = b"".join(good)
    assert [r.headers["x-page-id"] for r in warc.read_records(io.BytesIO(data))] == [str(k) for k in range(50)]
    assert gzip.decompress(good[0]).endswith(b"payload\r\n\r\n")  # any gzip reader sees the record
    for broken in (data[:-3], b"".join([good[0], warc.record_bytes(1, "u", b"other", sha1, None, False)]), gzip.compress(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcdef\r\n\r\n"), gzip.compress(b"nothing")):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(broken)))


# -- token files ---------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return token_files.read_ranks("/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


def test_counts_equal_encoder(spark, ranks):
    import tiktoken

    texts = [None, "", " ", "one", "two words", "ñandú\n\n  x", "word " * 40000, "x" * 500, "<|endoftext|>"] * 3
    docs = spark.createDataFrame([(k if k else None, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, place int").repartition(4)
    got = {r.doc_id: r.n_tokens for r in token_files.count_tokens(docs, ranks, 50256).collect()}
    plain = tiktoken.Encoding("plain", pat_str=token_files.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert got == {k if k else None: len(plain.encode_ordinary(t or "")) for k, t in enumerate(texts)}
    assert token_files.count_tokens(docs.limit(0), ranks, 50256).collect() == []
    with pytest.raises(ValueError):
        token_files.write(docs, ranks, 100)


@pytest.mark.parametrize("block_tokens", [1, 3, 7, 1 << 20])
def test_stitching_across_blocks(spark, block_tokens):
    folder = scratch_path(spark, "flat")
    import os

    os.makedirs(folder)
    rng = random.Random(block_tokens)
    want = set()
    for k, lengths in enumerate([[3, 0, 0, 12, 1], [], [40], [rng.randrange(9) for _ in range(30)]]):
        ids = [x for n in lengths for x in [5] * n + [9]]
        path = f"file://{folder}/{k}.bin"
        want |= {(path, place, n, True) for place, n in enumerate(lengths)}
        if k % 2:
            ids += [5] * 4
            want.add((path, len(lengths), 4, False))
        np.array(ids, "<u2").tofile(f"{folder}/{k}.bin")
    files = spark.createDataFrame([(f"file://{folder}/{k}.bin",) for k in range(4)], "path string")
    got = token_files.scan(files, 9, block_tokens=block_tokens).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_operators_leave_other_columns(spark):
    docs = spark.createDataFrame([(1, "text", "keep")], "doc_id long, text string, extra string")
    assert nbsvm.score(docs, nbsvm.Model(None, None, 0.0)).first() == (1, "text", "keep", 0.5)
    assert html_text.extract(docs.withColumnRenamed("text", "html")).select("extra", F.col("text")).first() == ("keep", "text")


def test_copies_of_the_response_are_numbered(spark):
    body = "x" * 1200
    rows = [(9, "u1", body)] * 3 + [(9, "u0", body), (9, None, body), (4, "u2", body), (None, "u3", body), (9, "u4", "y" * 1200), (1, "a", "z" * 1500), (1, "b", "z" * 1500), (3, "c", "short"), (2, "d", "short")]
    got = warc.plan_records(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert Counter((r.page_id, r.url, bytes(r.payload).decode()) for r in got) == Counter(rows)
    assert {(r.page_id, r.url) for r in got if not r.revisit} == {(9, None), (9, "u4"), (1, "a"), (3, "c"), (2, "d")}
    assert Counter((r.page_id, r.refers_to) for r in got if r.revisit) == Counter({(9, 9): 4, (4, 9): 1, (None, 9): 1, (1, 1): 1})
    assert all(r.refers_to is None for r in got if not r.revisit)


def test_unbroken_stretches_are_encoded_whole():
    rng = random.Random(4)
    encoder = token_files.Encoder(token_files.read_ranks("/opt/tokenizers/byte_bpe_multi_50k.tiktoken"), token_files.PATTERN)
    runs = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (49_999, 50_001, 52_000)] + ["7" * 120_000, " " * 60_000 + "x", "ab cd " * 20_000, "1 2 " * 30_000]
    for text in runs:
        whole = encoder.encoding.encode_ordinary(text)
        assert np.concatenate(list(encoder.encode(text))).tolist() == whole
