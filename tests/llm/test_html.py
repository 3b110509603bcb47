"""Parsing, message passing against enumeration, and held-out layouts."""

import itertools

import numpy as np
import pytest

from colloquy.llm import html


@pytest.fixture(scope="module")
def model():
    return html.train()


def test_marginals_equal_enumeration():
    tree = html.parse("<div><p>one two</p><ul><li><a href=x>a</a></li></ul></div>")
    forest = html.Forest.of([tree])
    m = html.Model()
    rng = np.random.default_rng(1)
    m.own, m.edge = rng.normal(size=m.own.shape), rng.normal(size=m.edge.shape)
    n = len(tree.parent)
    score = forest.x @ m.own
    weight = np.zeros((n, 2))
    total = 0.0
    for state in itertools.product((0, 1), repeat=n):
        w = np.exp(sum((score[i] / 2 if state[i] else -score[i] / 2) for i in range(n)) + sum(m.edge[forest.kind[i], state[tree.parent[i]], state[i]] for i in range(1, n)))
        total += w
        for i in range(n):
            weight[i, state[i]] += w
    node, pair = m.messages(forest)
    assert np.allclose(node, weight / total)
    assert np.allclose(pair[1:].sum(1)[:, 1], node[1:, 1])


def test_held_out_layouts(model):
    good = wrong = missed = 0
    pages = html.labelled_pages(150, seed=12345)
    for (_, content), text in zip(pages, model.main_text([p for p, _ in pages]), strict=True):
        got = set(text.split("\n\n")) - {""}
        good, wrong, missed = good + len(got & content), wrong + len(got - content), missed + len(content - got)
    assert good / (good + wrong) > 0.97 and good / (good + missed) > 0.97


PAGE = (
    '<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">menu</a></li></ul></nav>'
    '<!-- ad --><div class="ad">Buy this now.</div><article><h1>A &amp; B</h1><p><b>First&nbsp; one.<br>more<p>Second &lt;x&gt;\n one.</p>{}</article>'
    '<form><p>Sign up</p><input></form><footer>&copy; site</footer></body></html>'
)


def test_page(model):
    comments = '<section class="comments"><h3>Comments</h3><p>I liked this a lot, thanks.</p></section>'
    for extra in ("", comments, '<div class="cookie-notice">We use cookies.</div>'):
        assert model.main_text([PAGE.format(extra)]) == ["A & B\n\nFirst one. more\n\nSecond <x> one."]


def test_odd_input(model):
    cases = {None: "", "": "", "just text": "just text", "<p>open <b>bold": "open bold", "<p>cut <a hre": "cut", "a < b and 3 > 2 &am": "a < b and 3 > 2 &am", "<script>x": "", "<!-- never closed <p>x": "", "<p>x</p" : "x", "<br/><hr>": "", "</div></p>y": "y"}
    assert model.main_text(list(cases)) == list(cases.values())
    deep = "<div>" * 3000 + "deep text here" + "</div>" * 3000
    assert html.parse(deep).depth[-1] == 3001
    long = "<article>" + "<p>" + "word " * 100_000 + "</p></article>"
    assert len(model.main_text([long])[0]) == 499_999


def test_table(spark, model):
    rows = [(1, "u", PAGE.format(""), "x"), (1, "u", PAGE.format(""), "x"), (2, None, None, "x"), (None, "v", "", "x")]
    out = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), model).collect()
    assert sorted(r.n_chars for r in out) == [0, 0, 39, 39] and all(r.n_chars == len(r.text) for r in out)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string"), model).count() == 0


def test_formulas_and_objects_inside_an_article_are_text(model):
    page = PAGE.format("<p>The law <math><mi>E</mi>=<mi>m</mi></math> holds, as <object>this figure</object> shows.</p>")
    assert model.main_text([page])[0].endswith("The law E=m holds, as this figure shows.")
