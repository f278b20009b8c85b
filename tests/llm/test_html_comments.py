"""Reader comments and sidebars of any length, deep nesting, and the ratio steps of the extraction."""

import math
import time

import numpy as np
import pytest

from msgtriage.llm import html_text

BODY = ["The council met on Tuesday to settle the plan for the bridge over the river.", "It will vote again in spring, after the engineers have measured the piers."]
ARTICLE = "<article><h1>A bridge</h1>" + "".join(f"<p>{x}</p>" for x in BODY)
TEXT = "\n\n".join(["A bridge", *BODY])
REMARK = "<p>I have walked over this bridge each day for years, and remark %d is that it shakes in the wind.</p>"

THREADS = {
    "class": '<div class="comments">%s</div>',
    "id": '<section id="comments">%s</section>',
    "list": '<div class="comment-list">%s</div>',
    "users": '<div id="user-comments">%s</div>',
    "readers": '<div class="reader-feedback">%s</div>',
    "sidebar": '<div class="sidebar">%s</div>',
    "hidden": '<div style="color:red; display:none">%s</div>',
    "articles": '<section class="comments-area"><article class="comment">%s</article></section>',
}


@pytest.mark.parametrize("markup", THREADS)
@pytest.mark.parametrize("times", [3, 10, 100])
@pytest.mark.parametrize("inside", [True, False])
def test_comments_longer_than_the_article(markup, times, inside):
    remarks = "".join(REMARK % i for i in range(times * 3))
    thread = THREADS[markup] % remarks
    page = ARTICLE + (thread + "</article>" if inside else "</article>" + thread)
    assert html_text.main_text(f"<html><body><nav><a href=x>Home</a></nav>{page}<footer>imprint</footer></body></html>") == TEXT


@pytest.mark.parametrize("markup", [m for m in THREADS if m != "articles"])
def test_comments_of_a_page_without_article(markup):
    thread = THREADS[markup] % "".join(REMARK % i for i in range(30))
    page = ARTICLE.replace("<article>", '<div class="post">') + "</div>" + thread
    assert html_text.main_text(f"<body>{page}</body>") == TEXT


def test_nested_and_following_articles_are_comments():
    remarks = "".join(f"<article>{REMARK % i}</article>" for i in range(9))
    assert html_text.main_text(f"<body>{ARTICLE}<section>{remarks}</section></article></body>") == TEXT
    wrapped = f'<body><article class="page">{ARTICLE}</article></article></body>'
    assert html_text.main_text(wrapped) == TEXT


def test_unnamed_thread_after_the_article():
    thread = "<div>" + "".join(f'<div class="x7">{REMARK % i}</div>' for i in range(50)) + "</div>"
    assert html_text.main_text(f"<body>{ARTICLE}</article>{thread}</body>") == TEXT


def test_teasers_after_the_text_are_not_the_article():
    text = "".join(f"<p>{x} {x}</p>" for x in BODY)
    got = html_text.main_text(f"<body><div><h1>A bridge</h1>{text}</div><article><p>{BODY[0]}</p></article></body>")
    assert all(f"{x} {x}" in got for x in BODY)


def test_names_stay_wrong_where_nothing_else_is():
    """A page whose only text has such a name, and frames named after their sidebar."""
    assert html_text.main_text(f'<body><div class="comments"><p>{BODY[0]}</p><p>{BODY[1]}</p></div></body>') == "\n\n".join(BODY)
    frame = ARTICLE.replace("<article>", '<div class="main-sidebar-content">') + "</div>"
    assert html_text.main_text(f"<body>{frame}</body>") == TEXT
    section = f'<body>{ARTICLE}<h2 id="comment-on-costs">Costs</h2><p>{BODY[0]}</p></article></body>'
    assert html_text.main_text(section) == TEXT + "\n\nCosts\n\n" + BODY[0]


@pytest.mark.parametrize("piece", ["<div>word ", '<div class="ad">word ', "<div><p>word </section>", "<p><span>word </p>", '<article class="comment">word '])
def test_deep_nesting_takes_time_in_proportion(piece):
    start = time.process_time()
    html_text.main_text(ARTICLE + "</article>" + piece * 50_000)
    assert time.process_time() - start < 20


def brute_mask(lines, sigma):
    """The definition, by plain sums: ratio, weighted mean over the neighbours, 2-means on a line."""
    ratio = [max(0, len(x.text) - x.linked) / (1 + x.tags) for x in lines]
    reach = math.ceil(3 * sigma)
    smooth = []
    for i in range(len(ratio)):
        near = [(math.exp(-((i - j) ** 2) / (2 * sigma**2)), ratio[j]) for j in range(max(0, i - reach), min(len(ratio), i + reach + 1))]
        smooth.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    low, high = min(smooth), max(smooth)
    for _ in range(20):
        groups = [[x for x in smooth if (x > (low + high) / 2) == up] for up in (False, True)]
        if not all(groups):
            break
        low, high = (sum(g) / len(g) for g in groups)
    mean = sum(smooth) / len(smooth)
    spread = math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth))
    return smooth, min(spread, (low + high) / 2)


def test_ratios_and_clusters_against_plain_sums():
    rng = np.random.default_rng(5)
    for sigma in (0.7, 1.5, 3.0):
        for _ in range(40):
            blocks = [f"<p>{'<b>x</b>' * int(rng.integers(0, 4))}{'<a href=y>link</a>' * int(rng.integers(0, 3))}{'w' * int(rng.integers(0, 300))}.</p>" for _ in range(int(rng.integers(1, 40)))]
            lines, _ = html_text.page_lines("".join(blocks), sigma)
            smooth, cut = brute_mask(lines, sigma)
            got = html_text.smoothed_ratios(lines, sigma)
            assert np.allclose(got, smooth)
            mask = html_text.content_mask(got)
            assert all(m == (x >= cut) for m, x in zip(mask, smooth) if abs(x - cut) > 1e-9)
