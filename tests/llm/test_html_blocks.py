from __future__ import annotations

import html
import re
import time

import numpy as np
import pytest

from helpers import SMALL, table
from millrace.llm.html_blocks import Labeller, blocks_of, extracted, features, sampled, trained
from millrace.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(spark):
    return trained(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def article_of(page: str) -> str:
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [re.sub(r"<[^>]+>", "", re.sub("<br>", " ", p)) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


def test_query_finds_the_articles(spark):
    rows = {r["page_id"]: r for r in QUERIES["op5_html_extraction"](spark, SMALL).collect()}
    pages = table("pages")
    assert len(rows) == len(pages)
    assert sum(rows[i]["text"] == article_of(h) for i, _, h in pages) >= 0.97 * len(pages)
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())


def test_blocks():
    page = (
        "<!DOCTYPE html><style>p{}</style><script>var t='</p>';</script><ul><li>one<li>two <b>bold</b></ul><!-- <p>no</p> -->"
        "<p>a &lt;b&gt;\n &amp;amp;<br>c<p>d</div><P CLASS='x y'>e<img src='a>b'>"
    )
    assert [b.text for b in blocks_of(page)] == ["one", "two bold", "a <b> &amp; c", "d", "e"]
    assert blocks_of(page)[-1].path[-1] == ("p", "x", "y")
    assert blocks_of(None) == blocks_of("") == blocks_of("<p> &nbsp; </p>") == []
    assert [b.text for b in blocks_of("no tags < at all")] == ["no tags < at all"]


def test_other_layouts(model):
    told = ["Onha the erat of than with, erin thou that. Ening the re of.", "Ntan in thntre inthing a in shnt the of erresh ined."]
    body = "".join(f"<p>{t}</p>" for t in told)
    for layout in (
        "<div class='menu'><a href=1>one</a> <a href=2>two</a></div><div id='main-content'>%s</div><div class='footer'>&copy; x</div>",
        "<header>Site</header><main>%s</main><section class='comments'><p>No, the erat of than.</p></section><footer>x</footer>",
        "<div class='cookie-notice'>We use cookies.</div><article>%s</article><aside>More</aside>",
    ):
        blocks = blocks_of("<html><body>" + layout % body + "</body></html>")
        chosen = model.probabilities(*features([blocks])) >= 0.5
        assert [b.text for b, c in zip(blocks, chosen) if c] == told


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    made = Labeller(4, 3)
    x, offsets = rng.normal(size=(7, 4)), np.array([0, 4, 4, 7])
    target, weight = rng.integers(0, 2, 7), np.ones(7)

    def loss() -> float:
        p = made.probabilities(x, offsets)
        return float(-(target * np.log(p) + (1 - target) * np.log(1 - p)).sum() / 7)

    for name, gradient in made.gradients(x, offsets, target, weight).items():
        w = made.weights[name]
        at = tuple(int(i) for i in rng.integers(0, w.shape))
        w[at] += 1e-5
        above = loss()
        w[at] -= 2e-5
        assert gradient[at] == pytest.approx((above - loss()) / 2e-5, abs=1e-7)
        w[at] += 1e-5


def test_odd_pages(spark, model):
    rows = [(1, None, None), (1, "u", ""), (None, "u", "<p>"), (2, "u", "<script>x"), (3, None, "<article><p>" + "long text. " * 30_000)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, text int")
    found = extracted(frame, model).collect()
    assert [r["text"] for r in found][:4] == [""] * 4 and found[4]["n_chars"] == len("long text. " * 30_000) - 1
    assert extracted(frame.limit(0), model).count() == 0 and trained(frame.limit(0)).hidden == 16


def test_text_after_and_inside_other_elements_stays():
    for name in ("svg-icon", "template-card", "style-guide"):
        assert [b.text for b in blocks_of(f"<p>a</p><{name}></{name}><p>rest of article</p>")] == ["a", "rest of article"]
    for empty in ("<svg/>", "<svg class='x>y' viewBox=\"0 0 1 1\" />", "<math/>", "<math display='block' />", "<svg><path d='M0'/></svg>"):
        assert [b.text for b in blocks_of(f"<p>a</p>{empty}<p>rest</p>")] == ["a", "rest"]
    math = "<p>where <math><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow></math> holds</p><p>rest</p>"
    assert [b.text for b in blocks_of(math)] == ["where x=1 holds", "rest"]
    held = "<p>a <object data='f'><param name='n'>told inside</object> b</p><p>rest</p>"
    assert [b.text for b in blocks_of(held)] == ["a told inside b", "rest"]
    assert [b.text for b in blocks_of("<p>a</p><svg><text>no</text></svg><script>no</script><p>b</p>")] == ["a", "b"]


def test_unfinished_markup_loses_no_text():
    def texts(page):
        return [b.text for b in blocks_of(page)]

    for name in ("svg", "script", "style", "template", "iframe", "textarea"):
        assert texts(f"<p>a</p><{name}><p>rest</p>") == ["a", "rest"] == texts(f"<p>a</p><{name} x=1><p>rest</p><{name}>")
    assert texts("<p>a</p><noscript>told without scripts</noscript><p>b</p>") == ["a", "told without scripts", "b"]
    assert texts('<p title="abc>two</p>') == ["two"] and texts("<p title='abc>two</p>") == ["two"]
    assert texts('<p title="a>b">two</p>') == ["two"] and texts("<p it's>two</p><p isn't>three</p>") == ["two", "three"]
    assert texts("<p>one<b unfinished") == ["one"] and texts("<p>one<b unfinished <p>two") == ["onetwo"]
    assert texts("<p>a<!-- b <p>c") == ["a b", "c"] and texts("<p>a<!-- b --><p>c") == ["a", "c"]
    assert texts("1 < 2 <3 </ 4") == ["1 < 2 <3 </ 4"] and texts("<p>x</p") == ["x"]


@pytest.mark.parametrize(
    "piece", ["<script ", "<script>", "<svg x ", "<a \"", "<a x=\"", "<a x=\">\"", "<a x='>", "<!--", "<!-- >", "<div>a", "<div>a</b>", "</p>", "<", "<p", "&", "<textarea></textarea"]
)
def test_a_megabyte_of_malformed_markup_takes_linear_time(piece):
    started = time.perf_counter()
    blocks = blocks_of(piece * ((1 << 20) // len(piece)) + "<p>end</p>")
    features([blocks])
    assert time.perf_counter() - started < 8  # a second or two on an idle machine; a quadratic scan takes hours
    del blocks


def test_repeated_pages_are_pages_of_their_own(spark, model):
    page = "<html><body><article><p>Onha the erat of than with, erin thou that. Ening the re of.</p></article></body></html>"
    rows = [(1, "u", page), (1, "u", page), (2, None, page), (None, "v", page)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = extracted(frame, model).collect()
    assert sorted((r["page_id"] or 0, r["url"] or "") for r in found) == [(0, "v"), (1, "u"), (1, "u"), (2, "")]
    assert len({r["text"] for r in found}) == 1
    assert sampled(frame, 5) == [page] and sampled(frame.limit(0), 5) == []
