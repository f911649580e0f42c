import html
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadloom.llm import html_cut as hc
from threadloom.llm.common import table

P = hc.CutParams()
ARTICLE = "<p>A long enough sentence of the article, with a point. And one more of them.</p>"


def main(page):
    return hc.content(page, hc.PRIOR, P)


def energy(labels, unary, ties):
    return sum(-u * x for u, x in zip(unary, labels)) + sum(w for a, b, w in ties if labels[a] != labels[b])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=9), st.data())
def test_cut_is_minimal(unary, data):
    n = len(unary)
    ties = [(a, b, w) for a, b, w in data.draw(st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(1, 15)), max_size=16)) if a != b]
    got = hc.minimum_cut(np.array(unary, float), ties)
    best = min(energy(x, unary, ties) for x in itertools.product([0, 1], repeat=n))
    assert energy(got.astype(int), unary, ties) == pytest.approx(best)


def test_long_chain_is_quick():
    rng = np.random.default_rng(0)
    hc.minimum_cut(rng.normal(0, 1, 20_000), [(i, i + 1, 1.0) for i in range(19_999)])


def expected(page):
    inner = re.search(r"<article>(.*?)(?:</article>|$)", page, re.DOTALL).group(1)
    parts = [re.sub(r"<[^>]*>", " ", x) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(t for t in (" ".join(html.unescape(x).split()) for x in parts) if t)


def test_table(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    truth = {r.page_id: r for r in pages.collect()}
    out = hc.extract(pages).collect()
    assert len(out) == len(truth)
    for r in out:
        assert r.text == expected(truth[r.page_id].html) and r.n_chars == len(r.text) and r.url == truth[r.page_id].url


def test_boilerplate_goes():
    page = f"""<html><body><header><a href=x>Home</a></header><nav><ul><li>Menu</ul></nav><div class="cookieNotice">We use cookies.</div>
      <article><h1>Title &amp; more</h1>{ARTICLE}<div class="ad">Buy this.</div><p>Second&nbsp;&nbsp;part
      goes <b>on</b>.<aside>Related</aside><script>var x = "</p><p>no";</script><!-- <p>not this</p> --></article>
      <section id="comments"><p>A reader writes a long comment, with a sentence. And more.</p></section>
      <form><p>Your name</p></form><footer>&copy; someone</footer>"""
    assert main(page) == "Title & more\nA long enough sentence of the article, with a point. And one more of them.\nSecond part goes on."


def test_pages_without_article():
    body = "".join(f"<p>Sentence number {i} is long enough to count as prose. It has two.</p>" for i in range(4))
    links = "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(6))
    assert main(f"<div><ul>{links}</ul></div><div>{body}</div><div><ul>{links}</ul></div>").count("\n") == 3
    assert main(f"<div>{body}<p>Short</p>{body}</div>").count("Short") == 1


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "</", "<!--", "plain &am", "<script>", "<p>" * 5000, "</div>" * 50, "<div>" * 5000 + "x", "<b class='ad'>x</b>", "<a title='>'>", "&#0;&#x110000;"])
def test_odd_pages(page):
    main(page)


def test_edge_cases(spark):
    schema = "page_id long, url string, html string, text string, n_chars long"
    rows = [(1, None, None), (None, "u", f"<article>{ARTICLE}</article>"), (2, "u", ""), (3, "u", "<article>" + ARTICLE * 3000 + "</article>"), (1, None, None)]
    out = sorted(hc.extract(spark.createDataFrame([(*r, "clash", 5) for r in rows], schema)).collect(), key=lambda r: r.n_chars)
    assert [r.text for r in out[:3]] == [""] * 3 and out[3].page_id is None and out[4].text.count("\n") == 2999
    assert hc.extract(spark.createDataFrame([], schema)).count() == 0


TWO = "A long enough sentence of the article, with a point. And one more of them."


@pytest.mark.parametrize("page", [
    f"<html class='no-ads'><body class='page no-sidebar'><article>{ARTICLE}{ARTICLE}</article></body></html>",
    f"<body><main class='content with-sidebar'>{ARTICLE}{ARTICLE}</main></body>",
    f"<body><article id='comment-policy'>{ARTICLE}{ARTICLE}</article></body>",
    f"<body><form id='aspnetForm'><nav>Menu</nav><article>{ARTICLE}{ARTICLE}</article></form></body>",
    f"<body><form><nav>Menu</nav><div>{ARTICLE}{ARTICLE}</div></form></body>",
    f"<body class='no-sidebar'><div>{ARTICLE}{ARTICLE}</div></body>",
    f"<body><div class='page with-sidebar'><article>{ARTICLE}{ARTICLE}</article></div></body>",
])
def test_names_and_forms_around_the_page(page):
    assert main(page) == f"{TWO}\n{TWO}"


def test_named_prose_is_left_to_the_cut():
    section = f"<section id='related-work'>{ARTICLE * 3}</section>"
    page = f"<article>{ARTICLE}{section}{ARTICLE}<div class='ad'>Buy this.</div>{ARTICLE}<ul class='share'><li><a href=x>Share</a></li></ul></article><div id='sidebar'><a href=y>More</a></div>"
    assert main(page) == "\n".join([TWO] * 6)


@pytest.mark.parametrize("tag", ["video", "audio", "object", "canvas", "svg", "noscript", "select"])
def test_unclosed_unseen_elements_end_with_their_parent(tag):
    assert main(f"<body><div><{tag} title=x>not shown</div><article>{ARTICLE}</article></body>") == TWO
    twice = f"<{tag}>no</{tag}>"
    assert main(f"<body><div><{tag}>not shown</div><article>{ARTICLE}</article><div>{twice}</div></body>") == TWO


PROSE = "<p>A reader writes a long comment here, with a whole sentence in it. And then there is one more.</p>"
FULL = ARTICLE * 4


@pytest.mark.parametrize("page", [
    f"<article>{FULL}<div class='comments'>{PROSE * 2}</div></article>",
    f"<main>{FULL}<section id='comments'>{PROSE * 9}</section></main>",
    f"<main><article>{FULL}</article><article class='comment'>{PROSE}</article><article class='comment odd'>{PROSE}</article></main>",
    f"<body><div><h2></h2>{FULL}</div><div class='comment-list'>{PROSE * 8}</div></body>",
    f"<article>{FULL}<article><p>Ann, 3 May</p>{PROSE}</article><article>{PROSE}</article></article>",
    f"<article>{ARTICLE * 2}<div class='newsletter-box'><p>Get our letter every week, it is free of charge. Join now.</p></div>{ARTICLE * 2}</article>",
    f"<article>{FULL}<form action=x><p>Tell us what you think about this text. We read it all.</p></form></article>",
    f"<body><div id='cookieNotice'><p>We use cookies to make this site work for you. Accept them all.</p></div><article>{FULL}</article></body>",
    f"<body><div class='alert'><p>The office is closed on Monday. Please come another day.</p></div><main>{FULL}</main></body>",
])
def test_comments_forms_and_notices_go(spark, page):
    weights = trained(spark)
    want = "\n".join([TWO] * 4)
    assert hc.content(page, weights, P) == want and main(page) == want


_WEIGHTS = []


def trained(spark):
    """Weights of the given pages, whose boilerplate has no paragraphs."""
    if not _WEIGHTS:
        _WEIGHTS.append(hc.train(table(spark, "/root/testdata/sf0.01", "pages"), P))
    return _WEIGHTS[0]


@pytest.mark.parametrize("page", [
    f"<article class='post comment-policy'>{FULL}</article>",
    f"<article><div class='related-work'>{FULL}</div></article>",
    f"<article><section class='menu-engineering'>{ARTICLE * 2}</section>{ARTICLE * 2}</article>",
    f"<article class='list'><article>{FULL}</article><article>{PROSE}</article></article>",
    f"<div class='comments'>{FULL}</div>",
    f"<form><article>{FULL}</article><button>Send</button></form>",
])
def test_articles_with_such_names_stay(spark, page):
    assert hc.content(page, trained(spark), P) == "\n".join([TWO] * 4)
