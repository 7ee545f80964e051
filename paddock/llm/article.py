"""Main text of web pages: boosted trees over DOM nodes, hierarchical decoding.

Each block element gets features: its tag, the kinds of words in its class, id
and role and in those of its ancestors, text and link densities of its subtree,
punctuation, depth, place and size among its siblings, share of the page. Gradient-
boosted trees (logistic loss, binned features, numpy) give the probability that
the node's text is article text. They are trained on the driver from
``TRAIN_PAGES`` made pages of many layouts whose nodes are labelled by
construction; that sample's size is fixed and its pages are seeded.

Decoding gives every node one of three states: outside (around the article),
main, or cut. Below main there is main or cut, below cut only cut, so no article
text stands inside a menu and no choice of a node contradicts its ancestors'.
The best assignment of the whole tree is found bottom-up from the log
probabilities. The text blocks of main nodes, in page order, are the article.

Pages are parsed whole, one at a time, inside the tasks. Null html is empty.
Ties prefer cut over main. Character references are decoded, white space inside
a block becomes one space, empty blocks are left out.
"""

from __future__ import annotations

import functools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm.dom import Page, block_text, parse, words_of

TRAIN_PAGES = 800
TREES, DEPTH, RATE, BINS = 60, 4, 0.25, 16
TAGS = ["p", "h1 h2 h3 h4 h5 h6", "ul ol dl menu", "li dt dd", "div center", "section", "article", "main", "nav", "header",
        "footer", "aside", "form fieldset label button select option", "table tbody thead tr td th", "blockquote pre figure figcaption", "body html"]
_TAG = {t: i for i, names in enumerate(TAGS) for t in names.split()}
#: Kinds of words in class, id and role.
KINDS = {
    "content": "article content entry post story text body main page single prose markdown blog copy richtext",
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs crumbs pagination pager tabs toolbar skip topbar sitemap toc",
    "ad": "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion dfp adsense",
    "side": "sidebar side aside rail widget widgets related recommended recommendations popular trending more also teaser",
    "foot": "footer foot copyright legal colophon credits bottom",
    "head": "header masthead logo brand hero top branding",
    "comment": "comment comments reply replies respond disqus discussion discussions reviews guestbook thread feedback",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay message warning newsletter subscribe subscription signup dialog alertdialog",
    "social": "share sharing social tweet facebook twitter follow likes print email",
    "form": "form search login register contact input field",
    "meta": "byline author date meta tags tag caption category categories",
}
_WORD = {w: i for i, names in enumerate(KINDS.values()) for w in names.split()}
_SEMANTIC = {"nav": "nav", "header": "head", "footer": "foot", "aside": "side", "form": "form", "button": "form", "select": "form",
             "label": "form", "fieldset": "form", "article": "content", "main": "content", "dialog": "notice", "menu": "nav"}
_KIND = {k: i for i, k in enumerate(KINDS)}


@functools.lru_cache(maxsize=1 << 14)
def _kinds(tag: str, attrs: str) -> int:
    """Bits of the kinds of a node's own words and tag."""
    bits = 0
    for w in words_of(attrs):
        k = _WORD.get(w)
        if k is not None:
            bits |= 1 << k
    return bits | (1 << _KIND[_SEMANTIC[tag]] if tag in _SEMANTIC else 0)


def features(page: Page) -> np.ndarray:
    """One row per node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    own = np.array([page.chars, page.links, page.stops, page.spaces, [t == "p" for t in page.tag],
                    [t == "li" for t in page.tag], [1] * n], float).T
    total = own.copy()
    kinds, above = [0] * n, [0] * n
    place, kids, same, seen = [0] * n, [0] * n, [0] * n, {}
    for i in range(1, n):
        p = page.parent[i]
        kinds[i] = _kinds(page.tag[i], page.attrs[i])
        above[i] = above[p] | kinds[p]
        place[i] = kids[p]
        kids[p] += 1
        key = (p, page.tag[i])
        seen[key] = seen.get(key, 0) + 1
    for i in range(n - 1, 0, -1):
        total[page.parent[i]] += total[i]
        same[i] = seen[page.parent[i], page.tag[i]]
    before = np.cumsum(own[:, 0]) - own[:, 0]
    prev, nxt, last = np.zeros(n), np.zeros(n), {}
    largest = np.zeros(n)
    for i in range(1, n):
        p = page.parent[i]
        if p in last:
            prev[i] = total[last[p], 0]
            nxt[last[p]] = total[i, 0]
        last[p] = i
        largest[p] = max(largest[p], total[i, 0])
    chars, up = total[:, 0], np.maximum(parent, 0)
    whole = max(1.0, chars[0])
    one = np.maximum(chars, 1)
    bits = np.arange(len(KINDS))
    tag = np.full(n, len(TAGS))
    for i, t in enumerate(page.tag):
        tag[i] = _TAG.get(t, len(TAGS))
    return np.concatenate([
        tag[:, None] == np.arange(len(TAGS) + 1),
        np.array(kinds)[:, None] >> bits & 1, np.array(above)[:, None] >> bits & 1,
        np.stack([
            np.array(page.depth), np.array(place), np.array(kids)[up], np.array(same), np.array(kids),
            np.log1p(chars), np.log1p(own[:, 0]), total[:, 1] / one, 100 * total[:, 2] / one, 10 * total[:, 3] / one,
            total[:, 4], total[:, 5], np.log1p(chars / total[:, 6]), chars / whole, before / whole, chars / np.maximum(chars[up], 1),
            chars / np.maximum(largest[up], 1), np.log1p(prev), np.log1p(nxt), np.full(n, np.log1p(whole)),
        ], axis=1)], axis=1).astype(np.float32)


class Trees:
    """Boosted trees of fixed depth over binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        b = self._bins(x)
        mean = y.mean()
        self.base = float(np.log(mean / (1 - mean)))
        self.depth, self.nodes = depth, []
        f = np.full(len(y), self.base)
        flat = b.astype(np.int64) + np.arange(b.shape[1]) * BINS
        for _ in range(trees):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p)
            feature, cut = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, BINS, np.int64)
            leaf = np.zeros(len(y), np.int64)
            for d in range(depth):
                width = b.shape[1] * BINS
                at = (leaf[:, None] * width + flat).ravel()
                sums = [np.bincount(at, np.repeat(v, b.shape[1]), 2 ** d * width).reshape(2 ** d, b.shape[1], BINS).cumsum(axis=2)
                        for v in (g, h)]
                gl, hl = sums
                gt, ht = gl[:, :, -1:], hl[:, :, -1:]
                gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
                best = gain.reshape(2 ** d, -1).argmax(axis=1)
                for k in range(2 ** d):
                    if gain[k].ravel()[best[k]] > 1e-6:
                        feature[2 ** d - 1 + k], cut[2 ** d - 1 + k] = divmod(int(best[k]), BINS)
                i = 2 ** d - 1 + leaf
                leaf = 2 * leaf + (b[np.arange(len(b)), feature[i]] > cut[i])
            value = np.bincount(leaf, g, 2 ** depth) / (np.bincount(leaf, h, 2 ** depth) + 1) * rate
            self.nodes.append((feature, cut, value))
            f += value[leaf]

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)], axis=1).astype(np.int8)

    def predict(self, x: np.ndarray) -> np.ndarray:
        b = self._bins(x)
        rows, f = np.arange(len(b)), np.full(len(b), self.base)
        for feature, cut, value in self.nodes:
            leaf = np.zeros(len(b), np.int64)
            for d in range(self.depth):
                i = 2 ** d - 1 + leaf
                leaf = 2 * leaf + (b[rows, feature[i]] > cut[i])
            f += value[leaf]
        return 1 / (1 + np.exp(-f))


def decode(parent: list[int], prob: np.ndarray) -> list[bool]:
    """Which nodes are main in the best consistent assignment."""
    n = len(parent)
    p = np.clip(prob, 1e-4, 1 - 1e-4)
    yes, no = np.log(p).tolist(), np.log(1 - p).tolist()
    cut, main, out = no[:], yes[:], no[:]              # best score of the subtree by the node's state
    for i in range(n - 1, 0, -1):
        k = parent[i]
        inside = cut[i] if cut[i] >= main[i] else main[i]
        cut[k] += cut[i]
        main[k] += inside
        out[k] += inside if inside >= out[i] else out[i]
    state = [0] * n                                     # 0 outside, 1 main, 2 cut
    state[0] = 1 if main[0] > max(cut[0], out[0]) else 0
    for i in range(1, n):
        above = state[parent[i]]
        if above == 2:
            state[i] = 2
        else:
            inside = 2 if cut[i] >= main[i] else 1
            state[i] = inside if above == 1 or max(cut[i], main[i]) > out[i] else 0
    return [s == 1 for s in state]


def article(page: Page, prob: np.ndarray) -> str:
    main = decode(page.parent, prob)
    return "\n".join(t for t in (block_text(raw) for node, raw in page.blocks if main[node]) if t)


def made_page(rnd: random.Random) -> str:
    """A page of a random layout; data-y marks article (1) and other (0) subtrees."""
    letters = rnd.choice(["aeioutnrslhdcm", "аеионтсрвл", "éèaeioußüñtnrs"])

    def word():
        return "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 9)))

    def words(a, b, stops=True):
        out = [word() + (rnd.choice([",", ".", ".", ""]) if stops and rnd.random() < 0.15 else "") for _ in range(rnd.randint(a, b))]
        return " ".join(out).capitalize() + ("." if stops else "")

    def attr(*names):
        if rnd.random() < 0.12:
            return ""
        name = rnd.choice(names)
        name = rnd.choice([name, f"{name}-{word()}" if letters[0] == "a" else name, f"site-{name}", f"{name} clearfix"])
        return f' {rnd.choice(["class", "class", "id"])}="{name}"'

    def links(tag="ul", a=3, b=12):
        return f"<{tag}>" + "".join(f'<li><a href="/{word()}">{words(1, 3, False)}</a></li>' for _ in range(rnd.randint(a, b))) + f"</{tag}>"

    def other(tag, attrs, body):
        return f'<{tag} data-y="0"{attrs}>{body}</{tag}>'

    def ad():
        return other(rnd.choice(["div", "div", "aside", "section"]), attr("ad", "ads", "advert", "banner", "sponsored", "promo"),
                     rnd.choice([words(2, 30), f'<a href="#">{words(2, 12)}</a>', f"<p>{words(3, 30)}</p>"]))

    def nav():
        return other(*rnd.choice([("nav", ""), ("nav", attr("menu", "nav")), ("div", attr("menu", "navbar", "breadcrumb", "navigation")), ("ul", attr("nav", "menu"))]),
                     rnd.choice([links(), links("ol"), " | ".join(f'<a href="#">{word()}</a>' for _ in range(rnd.randint(2, 9)))]))

    def notice():
        return other(rnd.choice(["div", "section", "dialog"]), attr("cookie-notice", "consent", "alert", "newsletter", "notice", "popup"),
                     f"<p>{words(6, 40)}</p>" + rnd.choice(["", f"<button>{word()}</button>", f'<a href="#">{word()}</a>']))

    def form():
        return other(*rnd.choice([("form", ""), ("form", attr("search", "login")), ("div", attr("search", "subscribe", "login"))]),
                     f"<label>{words(1, 4, False)}</label><input type=text>" + rnd.choice(["", f"<p>{words(3, 15)}</p>"]) + f"<button>{word()}</button>")

    def comments():
        tag = rnd.choice(["section", "div", "ol"])
        one = lambda: f'<{"li" if tag == "ol" else "div"}{attr("comment", "reply")}><b>{word()}</b><p>{words(3, 60)}</p></{"li" if tag == "ol" else "div"}>'
        return other(tag, f' {rnd.choice(["class", "id"])}="{rnd.choice(["comments", "comment-list", "discussion", "replies", "respond"])}"',
                     rnd.choice(["", f"<h3>{words(1, 3, False)}</h3>"]) + "".join(one() for _ in range(rnd.randint(1, 8))))

    def side():
        return other(rnd.choice(["aside", "aside", "div"]), attr("sidebar", "related", "widget", "popular"),
                     f"<h3>{words(1, 3, False)}</h3>" + rnd.choice([links(), f"<p>{words(5, 40)}</p>" + links("ul", 2, 5)]))

    def social():
        return other("div", attr("share", "social"), " ".join(f'<a href="#">{word()}</a>' for _ in range(rnd.randint(2, 6))))

    def top():
        return other(*rnd.choice([("header", ""), ("div", attr("header", "masthead")), ("header", attr("top", "header"))]),
                     rnd.choice([f"<h1>{words(1, 3, False)}</h1>", f"<div>{word()}</div>", f'<a href="/">{word()}</a>', f"<p>{words(2, 8)}</p>"]) + rnd.choice(["", links(), nav()]))

    def foot():
        return other(*rnd.choice([("footer", ""), ("footer", ""), ("div", attr("footer", "legal", "copyright"))]),
                     rnd.choice([f"&copy; {word()} &middot; {words(3, 30)}", links() + f"<p>{words(3, 20)}</p>", f"<p>&copy; {words(4, 30)}</p>"]))

    def body():
        out = [] if rnd.random() < 0.15 else [f"<{rnd.choice(['h1', 'h1', 'h2'])}>{words(1, 14, rnd.random() < 0.5)}</h1>"]
        if out and rnd.random() < 0.2:                  # the article's own heading
            out = [rnd.choice([f"<header>{out[0]}</header>", f'<div class="entry-header">{out[0]}</div>', f"<hgroup>{out[0]}</hgroup>"])]
        loose = rnd.random() < 0.3
        for _ in range(rnd.choice([1, 1, 2, 3, 5, 8, 14, 25])):
            kind = rnd.random()
            if kind < 0.72:
                t = words(1, rnd.choice([3, 20, 60, 150]))
                t = rnd.choice([t, t, t, f"<b>{t}<br>", f'{t} <a href="#">{words(1, 4)}</a> {t}', f"<em>{t}</em>"])
                out.append(f"<p>{t}" + ("" if loose else "</p>"))
            elif kind < 0.78:
                out.append(f"<h2>{words(1, 6, False)}</h2>")
            elif kind < 0.84:
                out.append("<ul>" + "".join(f"<li>{words(2, 20)}</li>" for _ in range(rnd.randint(1, 6))) + "</ul>")
            elif kind < 0.88:
                out.append(f"<blockquote><p>{words(5, 40)}</p></blockquote>")
            elif kind < 0.90:
                out.append(f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 8)}</td></tr></table>")
            elif kind < 0.92:
                out.append(f"<pre>{words(4, 30)}</pre>")
            else:
                out.append(rnd.choice([ad, ad, social, notice, side, form])())
        if rnd.random() < 0.12:
            out.append(rnd.choice([comments, comments, foot, social])())
        return "".join(out)

    style = rnd.random()
    if style < 0.45:
        main = f'<article data-y="1"{attr("post", "entry", "story") if rnd.random() < 0.4 else ""}>{body()}</article>'
        if rnd.random() < 0.3:
            main = f"<main>{main}</main>"
    elif style < 0.6:
        main = f'<main data-y="1">{body()}</main>'
    elif style < 0.92:
        main = f'<{rnd.choice(["div", "div", "section", "td"])} data-y="1"{attr("content", "article", "post-body", "entry-content", "main", "story", "text")}>{body()}</div>'
    else:
        main = f'<div data-y="1">{body()}</div>'
    if rnd.random() < 0.35:
        main = f"<div{attr('wrapper', 'container', 'page', 'row')}>{main}{rnd.choice([side, social, comments, ad])()}</div>"
    before = [x() for x in (notice, top, nav, ad, form, nav) if rnd.random() < 0.35]
    after = [x() for x in (social, comments, side, ad, form, notice, nav) if rnd.random() < 0.3] + [foot()] * (rnd.random() < 0.85)
    parts = "".join(before) + main + "".join(after)
    if rnd.random() < 0.05:
        return words(1, 120, rnd.random() < 0.7)
    if rnd.random() < 0.1:
        return rnd.choice([f'<body data-y="1">{body()}</body>', f'<body data-y="1">{body()}</body>',
                           f'<html data-y="1"><body>{words(1, 120)}</body></html>', f'<p data-y="1">{words(1, 60)}</p><p data-y="1">{words(1, 60)}'])
    page = f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><style>p{{}}</style></head><body>{parts}</body></html>"
    return page[:int(len(page) * rnd.uniform(0.5, 1))] if rnd.random() < 0.1 else page


def train(pages: int = TRAIN_PAGES, seed: int = 11) -> Trees:
    rnd = random.Random(seed)
    made = [parse(made_page(rnd)) for _ in range(pages)]
    for p in made:
        if len(p.tag) == 1:                             # bare text is the article
            p.label[0] = 1
    return Trees(np.concatenate([features(p) for p in made]), np.concatenate([np.array(p.label, float) for p in made]))


def extract_all(htmls: list[str | None], model: Trees, nodes: int = 20_000) -> Iterator[str]:
    """Article text of each page; features are scored ``nodes`` at a time."""
    held: list[Page] = []
    size = 0

    def out() -> Iterator[str]:
        x = [features(p) for p in held]
        prob = model.predict(np.concatenate(x))
        at = 0
        for p, f in zip(held, x, strict=True):
            yield article(p, prob[at:at + len(f)])
            at += len(f)

    for h in htmls:
        held.append(parse(h or ""))
        size += len(held[-1].tag)
        if size > nodes:
            yield from out()
            held, size = [], 0
    if held:
        yield from out()


def extract(pages: DataFrame, model: Trees, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all but the html) with text and n_chars."""
    keep = [c for c in (pages.columns if keep is None else keep) if c not in (html, "text", "n_chars")]
    shared = pages.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*[pages.schema[c] for c in keep], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                b = whole.slice(lo, 512)
                texts = list(extract_all(b.column(b.num_columns - 1).to_pylist(), shared.value))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [*keep, "text", "n_chars"])

    src = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(html).cast("string").alias("_html_in"))
    return src.mapInArrow(run, schema)
