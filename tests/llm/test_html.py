import numpy as np
import pytest

from churnlake.llm import html_crf as H

from .conftest import SMOKE


@pytest.fixture(scope="module")
def model(spark):
    return H.train(H.sample_pages(spark.read.parquet(f"{SMOKE}/pages.parquet")))


def brute_probabilities(scores, moves):
    import itertools
    total, node = 0.0, np.zeros_like(scores)
    for y in itertools.product((0, 1), repeat=len(scores)):
        w = np.exp(sum(scores[i][a] for i, a in enumerate(y)) + sum(moves[a][b] for a, b in zip(y, y[1:])))
        total += w
        for i, a in enumerate(y):
            node[i][a] += w
    return node / total


def test_marginals_and_viterbi_match_enumeration():
    import itertools
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 7):
        scores, moves = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
        assert np.allclose(H.marginals(scores, moves)[0], brute_probabilities(scores, moves))
        crf = H.Crf(scores, moves)
        best = max(itertools.product((0, 1), repeat=n),
                   key=lambda y: sum(scores[i][a] for i, a in enumerate(y)) + sum(moves[a][b] for a, b in zip(y, y[1:])))
        assert tuple(crf.decode([np.array([i]) for i in range(n)])) == best


def test_blocks():
    got = [b[0] for b in H.leaf_blocks("<p>a &amp; b&nbsp;&#233;<br>c<p>d<b>e</b>f</div><li>g<li>h<script>var x='</p>'</script><style>s</style><!-- no -->  i\n j</body>k")]
    assert got == ["a & b é c", "def", "g", "h", "i j", "k"]
    assert H.leaf_blocks("") == [] and H.leaf_blocks("<p>  </p>") == []


def test_held_out_layouts(model):
    body = "<h2>Title of it</h2><p>First paragraph &amp; more, with a line.<br>second</p><p>Short.</p><ul><li>item one</li></ul>"
    want = "Title of it\n\nFirst paragraph & more, with a line. second\n\nShort.\n\nitem one"
    for a, b in (("<article>", "</article>"), ("<main>", "</main>"), ('<div id="content">', "</div>"), ('<div class="post-body">', "</div>")):
        html = (f'<html><head><title>t</title></head><body><header><p>Site name, and its motto.</p></header><nav><a href="/">Home</a></nav>'
                f'<div class="cookie-notice"><p>We use cookies. Accept them.</p></div>{a}{body}<aside><p>Side note, quite long, to be read. Yes.</p></aside>'
                f'<form><label>Name</label><button>Send</button></form>{b}<section id="comments"><p>Great article, thanks a lot. I liked it.</p></section>'
                f'<div class="sidebar"><p>Popular posts, see them.</p></div><div class="ad">Buy this now.</div><footer>&copy; 2020</footer></body></html>')
        assert H.main_text(html, model) == want, a


def test_table(spark, model):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text"), (3, "u", "plain text"), (None, "u", "<article><p>x y</p></article>"), (4, "u", "<article><p>" + "word " * 50_000)]
    got = H.extract(spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string"), model=model).collect()
    assert len(got) == 6 and {r["page_id"]: r["text"] for r in got}[1] == "" and {r["page_id"]: r["n_chars"] for r in got}[4] == 249_999
    pages = spark.read.parquet(f"{SMOKE}/pages.parquet")
    assert H.extract(pages.limit(0)).count() == 0
    right = 0
    for r in H.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        blocks = H.leaf_blocks(r["html"])
        right += r["text"] == "\n\n".join(b[0] for b, y in zip(blocks, H.own_labels(blocks)) if y)
    assert right == pages.count()


def div_page(i, tag="div"):
    paras = "".join(f"<p>Paragraph {k} of page {i}, with a sentence or two of text. It goes on.</p>" for k in range(4))
    return (f'<html><head><title>t</title></head><body><nav><a href="/">Home</a></nav><{tag} class="text">{paras}</{tag}>'
            f'<div class="sidebar"><p>Popular posts, see them.</p></div><footer>&copy; 2020</footer></body></html>')


def div_text(i):
    return "\n\n".join(f"Paragraph {k} of page {i}, with a sentence or two of text. It goes on." for k in range(4))


@pytest.mark.parametrize("labelled", [0, 1, 3])
def test_pages_without_article_keep_their_text(spark, labelled):
    """None or a few of many pages have labels; the sample must find those, and no page loses its text."""
    rows = [(i, "u", div_page(i, "ARTICLE" if i < labelled else "div")) for i in range(1500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert len(H.sample_pages(pages)) == labelled
    got = {r["page_id"]: r["text"] for r in H.extract(pages).collect()}
    assert all(got[i] == div_text(i) for i in range(1500))


@pytest.mark.parametrize("html,want", [
    ("<html><head><title>t</title><meta charset=u><body><p>a</p>b", ["a", "b"]),      # </head> may be omitted
    ("<head><title>t</title><script>var x</script><p>a</p>b</body>", ["a", "b"]),
    ("<head><title>t</title><style>x</style>\n a <p>b", ["a", "b"]),
    ("<head><title>t<body><p>a", ["a"]), ("<head><noscript><body><p>a", ["a"]),
    ("<head><noscript><img src=x><p>no</p></noscript><title>t</title></head><body>a", ["a"]),
    ("<div><noscript>a<p>b</p></div>c", ["a", "b", "c"]), ("<div><template><p>a</p></div>", ["a"]), ("<svg><p>a", ["a"]),
    ("<div><noscript><p>no</noscript>a<template><li>no</template>b<svg/>c<svg><text>no</svg>d</div>", ["a", "b", "c", "d"]),
    ("<p>x is <math><mi>y</mi></math> here<p>a</p><object>b</object><canvas>c</canvas>", ["x is y here", "a", "b", "c"]),
    ("<p>one <script>var x='</p>'</script>two <style>s</style>three <template><p>no</p></template>four <noscript>no</noscript>five</p><h2>a<svg><title>no</title></svg> b</h2>",
     ["one two three four five", "a b"]),
])
def test_no_text_is_hidden_by_omitted_tags(html, want):
    assert [b[0] for b in H.leaf_blocks(html)] == want


TWO = "<h2>Title of it</h2><p>First paragraph, with a line.</p><p>Second one, rather short.</p>"
TWO_TEXT = "Title of it\n\nFirst paragraph, with a line.\n\nSecond one, rather short."
NAV, FOOT = '<nav><ul><li><a href="/">Home</a></li><li><a href="/a">About</a></li></ul></nav>', "<footer><p>&copy; 2020, all rights reserved.</p></footer>"
LAYOUTS = [
    (f'<body class="page has-sidebar">{NAV}<article>{TWO}</article>{FOOT}</body>', TWO_TEXT),
    (f'<html class="js cookie-consent"><body>{NAV}<article>{TWO}</article>{FOOT}</body></html>', TWO_TEXT),
    (f'<body>{NAV}<article class="post share-enabled">{TWO}</article>{FOOT}</body>', TWO_TEXT),
    (f'<article class="post share-enabled">{TWO}</article>', TWO_TEXT),
    (f'<body class="login-enabled"><main>{TWO}</main></body>', TWO_TEXT),
    (f'<body class="comments-open"><main class="with-sidebar">{TWO}</main></body>', TWO_TEXT),
    (f'<body><div class="layout with-sidebar"><article>{TWO}</article><div class="sidebar"><p>Popular posts, see them all. Yes.</p></div></div></body>', TWO_TEXT),
    (f'<body>{NAV}<main>{TWO}<article class="comment"><p>Great article, thanks a lot. I liked it.</p></article></main>{FOOT}</body>', TWO_TEXT),
    (f'<body>{NAV}<article>{TWO}</article><div id="div-comment-1" class="comment-body"><p>Great article, thanks a lot. I liked it.</p></div></body>', TWO_TEXT),
    ("A text without any mark-up, in one line. It goes on.", "A text without any mark-up, in one line. It goes on."),
    ("plain text", "plain text"),
    (f"<article>{TWO}</article>", TWO_TEXT),
    (f"<body>{NAV}<article>{TWO}</article><!-- x <p>lost?", TWO_TEXT),
]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_layouts_with_models_of_three_tables(spark, sf):
    model = H.train(H.sample_pages(spark.read.parquet(f"{SMOKE}/../{sf}/pages.parquet")))
    assert [(h, H.main_text(h, model)) for h, _ in LAYOUTS] == LAYOUTS


def test_names():
    assert H.names("page has-sidebar siteFooter js-nav comments-open x") == ("page", "site-footer", "nav")
    assert [H.names_boilerplate(n) for n in ("nav", "nav-bar", "site-footer", "comment-body", "google-ads-top", "content-sidebar-wrap", "page", "story")] == \
        [True, True, True, True, True, False, False, False]


def test_unclosed_comment_ends_with_the_page():
    assert [b[0] for b in H.leaf_blocks("<p>a</p><!-- x <p>lost?")] == ["a"]
    assert [b[0] for b in H.leaf_blocks("<script><!-- x</script><p>a</p><!-- y --><p>b")] == ["a", "b"]
