import html
import itertools
import random
import re

import numpy as np
import pytest

from paddock.llm import article
from paddock.llm.dom import block_text, parse
from paddock.llm.q_article import op9_html_extract


@pytest.fixture(scope="module")
def model():
    return article.train()


def test_held_out_made_pages(model):
    rnd = random.Random(99)
    good = 0
    for _ in range(200):
        p = parse(article.made_page(rnd))
        if len(p.tag) == 1:
            p.label[0] = 1
        want = "\n".join(t for t in (block_text(r) for n, r in p.blocks if p.label[n]) if t)
        good += article.article(p, model.predict(article.features(p))) == want
    assert good >= 175


def test_decode_is_best_and_consistent():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(2, 8))
        parent = [-1, *[int(rng.integers(0, i)) for i in range(1, n)]]
        prob = rng.random(n)

        def value(state):
            return sum(np.log(p if s == 1 else 1 - p) for s, p in zip(state, prob, strict=True))

        allowed = [s for s in itertools.product((0, 1, 2), repeat=n) if s[0] < 2 and all(
            (s[i] > 0 if s[parent[i]] == 1 else s[i] == 2 if s[parent[i]] == 2 else True) for i in range(1, n))]
        best = max(map(value, allowed))
        got = article.decode(parent, prob)
        assert max(value(s) for s in allowed if [x == 1 for x in s] == got) == pytest.approx(best)


def _article(h):
    """The text between the article tags of the test tables' pages."""
    i = h.find("<article>")
    if i < 0:
        return ""
    j = h.find("</article>", i)
    b = h[i + 9:j if j >= 0 else len(h)]
    if j < 0 and b.rfind("<") > b.rfind(">"):
        b = b[:b.rfind("<")]
    parts = re.split(r"</?(?:p|h1)>", b.replace("<br>", "\n"))
    return "\n".join(x for x in (" ".join(html.unescape(re.sub(r"</?b>", "", q)).split()) for q in parts) if x)


def _blocks(h):
    return [t for t in (block_text(r) for _, r in parse(h).blocks) if t]


def test_embedded_elements_keep_the_page():
    for e in ("svg", "math", "object", "noscript", "template"):
        assert _blocks(f"<p>One.</p><{e}><p>Two <b>bold</b>.</p><p>Three.</p>") == ["One.", "Two bold.", "Three."]
    assert _blocks('<p>A <svg width="1"/> and <math/> b.</p><p>C <svg><path d="M0"/></svg> d.</p>') == ["A and b.", "C d."]
    assert _blocks("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p>") == ["Let x=1 be."]
    assert _blocks("<p>See <svg><title>no</title><g><text>label</text></g></svg> here.</p>") == ["See label here."]
    assert _blocks('<p>An <object data="x"><b>old</b> reader</object> sees.<noscript> No script.</noscript></p>') == ["An old reader sees. No script."]
    assert _blocks("<p>a<script>x</script>b<template><p>t</p></template></p><p>c<style>z") == ["ab", "c"]


def test_attribute_values_have_no_length_limit():
    assert _blocks('<p title="' + "a > b " * 5000 + '">text</p><p>more</p>') == ["text", "more"]
    assert _blocks("<p title='" + "a > b " * 5000 + "'>text</p>") == ["text"]
    assert _blocks('<p class=a">one</p><p>it\'s "two"</p>') == ["one", 'it\'s "two"']


def test_query_on_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = op9_html_extract(spark, sf).collect()
    assert len(out) == len(pages)
    for r in out:
        p = pages[r["page_id"]]
        assert r["url"] == p["url"] and r["text"] == _article(p["html"]) and r["n_chars"] == len(r["text"])


def test_edge_cases(spark, model):
    long = "<article><h1>T</h1>" + "".join(f"<p>Some words, number {i}, of a text.</p>" for i in range(20_000)) + "</article>"
    deep = "<div>" * 20_000 + "x"
    rows = [(1, None, "u"), (2, "", None), (3, "<p>One, two.<p>Three &amp four, five.", None), (4, long, None), (5, deep, None),
            (6, "<script>var a='<p>';</script><!-- <p>x", None), (7, "a < b, and <b>c", None), (7, "a < b, and <b>c", None),
            (None, '<nav><a href="/">Home</a></nav><article><p>Text&nbsp;a,\n b.</p><p> </p></article><div class="comments"><p>I like it.</p></div>', "x"),
            (8, "<article><p>cut off, at <a hre", None)]
    df = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, html string, url string, text string, n_chars int")
    out = article.extract(df, model).collect()
    assert len(out) == len(rows)
    by = {r["page_id"]: r["text"] for r in out}
    assert by[1] == by[2] == by[6] == ""
    assert by[3] == "One, two.\nThree & four, five."
    assert by[4].count("\n") == 20_000 and by[4].startswith("T\nSome words, number 0")
    assert by[None] == "Text a, b." and by[8] == "cut off, at"
    assert article.extract(df.limit(0), model).count() == 0
    assert set(df.columns) == set(article.extract(df, model).columns) | {"html"}
