"""Main text of web pages: boosted trees over DOM nodes, decoded down the tree.

Every block element is a node with features: its tag and attribute tokens, those
of its ancestors, depth, text and link density of its subtree, sibling
statistics, place in the page.  Gradient-boosted trees give each node the
probability that it belongs to the article.  Decoding picks the likeliest
labels of the whole tree under one rule: nothing under a dropped node is kept.
The kept nodes' texts, in page order, are the article.

Pages come without labels, so the trees learn from pages that are put together
here: texts of a bounded sample of the given pages (``SAMPLE_PAGES``) are laid
out at random in the ways web pages are laid out, and each part's label is known
because it was put there.  The sample's texts are gathered by Spark; the
trees are fitted on the driver; extraction is one pass without a shuffle.

Defined cases: null or empty html has an empty text; so has a page without any
article; unclosed, wrongly nested and cut off markup is read like a browser
does, as far as it decides which text is where; repeated rows stay; other
columns than those asked for are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosted
from .dom import Node, block_texts, parse

SAMPLE_PAGES, TRAIN_PAGES, SAMPLE_TEXTS = 300, 1200, 20      # bounds of the fit
SAMPLE_WORDS, LEAST_CHARS = 120, 20     # of a text that is laid out anew: its first words, if it has more characters
RUN_PAGES = 256

#: Attribute tokens by what they speak for.
GROUPS = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip links",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner adsense",
    "side": "sidebar side aside widget widgets related recommended rail trending popular teaser complementary",
    "foot": "footer foot copyright legal colophon contentinfo",
    "head": "header head masthead topbar top logo branding hero sitename",
    "notice": "cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe signup alert paywall "
              "warning message disclaimer dialog",
    "comment": "comment comments commentlist disqus reply replies respond responses thread discussion reader feedback",
    "share": "share sharing social follow like tweet facebook",
    "form": "form search login register input contact",
    "body": "content article post entry main story text body page articlebody copy prose blog",
}
_GROUP_OF = {w: i for i, words in enumerate(GROUPS.values()) for w in words.split()}
TAGS = ("body div section article main p h1 h2 h3 h4 ul ol li dl dd table tr td blockquote pre figure nav header footer "
        "aside form fieldset button select details dialog address").split()
_TAG_OF = {t: i for i, t in enumerate(TAGS)}
ABOVE = "nav header footer aside form article main ul table dialog".split()
_ABOVE_OF = {t: i for i, t in enumerate(ABOVE)}
N_GROUPS, N_TAGS, N_ABOVE = len(GROUPS), len(TAGS) + 1, len(ABOVE)
N_FEATURES = N_TAGS + 2 * N_GROUPS + N_ABOVE + 16


def _groups(tokens: str) -> list[int]:
    return [g for g in {_GROUP_OF.get(w) for w in re.split(r"[^a-z0-9]+", tokens)} if g is not None]


def node_features(root: Node, nodes: list[Node]) -> np.ndarray:
    """Features of all nodes, in page order (parents before children)."""
    n = len(nodes)
    at = {id(x): i for i, x in enumerate(nodes)}
    own = np.array([sum(len(t) for _, t in x.runs) for x in nodes], np.float64)
    linked = np.array([x.linked for x in nodes], np.float64)
    tags = np.array([x.tags + 1 for x in nodes], np.float64)
    stops = np.array([sum(t.count(".") + t.count(",") for _, t in x.runs) for x in nodes], np.float64)
    parent = np.array([at[id(x.parent)] if x.parent is not None else -1 for x in nodes])
    before = np.cumsum(own) - own
    sub, sub_linked, sub_tags, sub_stops = own.copy(), linked.copy(), tags.copy(), stops.copy()
    for i in range(n - 1, 0, -1):
        for a in (sub, sub_linked, sub_tags, sub_stops):
            a[parent[i]] += a[i]
    out = np.zeros((n, N_FEATURES), np.float32)
    depth = np.zeros(n)
    total = max(1.0, sub[0])
    base = N_TAGS + 2 * N_GROUPS
    for i, x in enumerate(nodes):
        row = out[i]
        row[_TAG_OF.get(x.tag, N_TAGS - 1)] = 1
        up = parent[i]
        if up >= 0:
            depth[i] = depth[up] + 1
            above = out[up]
            row[N_TAGS + N_GROUPS:base] = np.maximum(above[N_TAGS:N_TAGS + N_GROUPS], above[N_TAGS + N_GROUPS:base])
            row[base:base + N_ABOVE] = above[base:base + N_ABOVE]
            place = _ABOVE_OF.get(x.parent.tag)
            if place is not None:
                row[base + place] = 1
        if x.tokens:
            for g in _groups(x.tokens):
                row[N_TAGS + g] = 1
        kids = x.children
        if kids:
            size = np.array([sub[at[id(c)]] for c in kids])
            same = len({c.tag for c in kids}) / len(kids)
            for j, c in enumerate(kids):
                o = out[at[id(c)]]
                o[-1], o[-2], o[-3] = j / len(kids), np.log1p(len(kids)), same
                o[-4] = np.log1p(size[j - 1]) if j else 0
                o[-5] = np.log1p(size[j + 1]) if j + 1 < len(kids) else 0
                o[-6] = size[j] / max(1.0, size.max())
    out[:, -7], out[:, -8], out[:, -9] = depth, np.log1p(own), np.log1p(sub)
    out[:, -10], out[:, -11] = sub / total, sub_linked / np.maximum(1, sub)
    out[:, -12], out[:, -13] = sub_tags / np.maximum(1, sub) * 100, sub_stops / np.maximum(1, sub) * 100
    out[:, -14], out[:, -15] = before / total, np.log1p([len(x.children) for x in nodes])
    out[:, -16] = [x.tag in ("h1", "h2", "h3", "h4", "p", "li", "td", "blockquote", "pre") for x in nodes]
    return out


def decode(nodes: list[Node], margin: np.ndarray) -> None:
    """Sets every node's label: the likeliest labelling in which a dropped node
    has no kept node below it.  A node counts by its own text."""
    at = {id(x): i for i, x in enumerate(nodes)}
    weight = np.array([0.2 + np.log1p(sum(len(t) for _, t in x.runs)) for x in nodes])
    keep = -np.logaddexp(0, -margin) * weight
    drop = -np.logaddexp(0, margin) * weight
    for i in range(len(nodes) - 1, 0, -1):
        up = at[id(nodes[i].parent)]
        keep[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    for i, x in enumerate(nodes):
        x.keep = bool(keep[i] >= drop[i]) and (i == 0 or x.parent.keep)


def extract(pages: Sequence[str | None], forest: boosted.Forest) -> list[str]:
    trees = [parse(p or "") for p in pages]
    features = [node_features(*t) for t in trees]
    margin = forest.margin(np.concatenate(features)) if features else np.empty(0)
    out, a = [], 0
    for (_, nodes), f in zip(trees, features, strict=True):
        decode(nodes, margin[a:a + len(f)])
        a += len(f)
        out.append(block_texts(nodes))
    return out


class Maker:
    """Pages of random layout whose parts are known."""

    def __init__(self, texts: Sequence[str], seed: int):
        self.random = random.Random(seed)
        self.texts = [t for t in texts if t.strip()] or ["No text is at hand here.", "A second sentence, then."]

    def chance(self, p):
        return self.random.random() < p

    def text(self, words=None):
        t = self.random.choice(self.texts)
        if words:
            t = " ".join(t.split()[:self.random.randint(1, words)])
        return t.replace("&", "&amp;").replace("<", "&lt;")

    def attrs(self, group, p=0.8):
        if not self.chance(p):
            return ""
        words = GROUPS[group].split()
        tokens = [self.random.choice(words)]
        if self.chance(0.4):
            tokens.append(self.random.choice(["box", "wrap", "inner", "block", "area", "x1", "container"]))
        sep = self.random.choice(["-", " ", "_"])
        return f' {self.random.choice(["class", "class", "id"])}="{sep.join(tokens)}"'

    def mark(self, keep, tag, attrs, inner):
        """An element; ``data-k`` tells its label to the trainer."""
        return f'<{tag}{attrs} data-k="{int(keep)}">{inner}</{tag}>'

    def links(self, keep=False):
        items = "".join(self.mark(keep, "li", "", f'<a href="#">{self.text(3)}</a>') for _ in range(self.random.randint(3, 9)))
        return self.mark(keep, "ul", "", items)

    def paragraphs(self, n, keep, words=None):
        return "".join(self.mark(keep, "p", "", self.inline(self.text(words))) for _ in range(n))

    def inline(self, t):
        if self.chance(0.1):
            t = f"<b>{t}</b>"
        if self.chance(0.1):
            t += f' <a href="#">{self.text(3)}</a>'
        return t

    def junk(self, kind):
        r = self.random
        if kind == "nav":
            tag = r.choice(["nav", "nav", "div", "ul"])
            return self.mark(0, tag, self.attrs("nav", 0.4 if tag == "nav" else 1), self.links())
        if kind == "ad":
            return self.mark(0, r.choice(["div", "div", "section", "aside", "p", "figure"]), self.attrs("ad", 1),
                             self.text(40) if self.chance(0.7) else self.paragraphs(r.randint(1, 2), 0))
        if kind == "side":
            tag = r.choice(["aside", "aside", "div", "section"])
            return self.mark(0, tag, self.attrs("side", 0.5 if tag == "aside" else 1),
                             (self.mark(0, "h3", "", self.text(4)) if self.chance(0.6) else "")
                             + (self.links() if self.chance(0.5) else self.paragraphs(r.randint(1, 3), 0)))
        if kind == "foot":
            tag = r.choice(["footer", "footer", "div"])
            inner = r.choice([f"&copy; {self.text(8)}", self.paragraphs(r.randint(1, 2), 0, 30), self.links(), self.text()])
            return self.mark(0, tag, self.attrs("foot", 0.2 if tag == "footer" else 1), inner)
        if kind == "head":
            tag = r.choice(["header", "header", "div"])
            return self.mark(0, tag, self.attrs("head", 0.3 if tag == "header" else 1),
                             (self.mark(0, r.choice(["h1", "h2", "p", "div"]), "", self.text(6)))
                             + (self.junk("nav") if self.chance(0.4) else "")
                             + (self.paragraphs(1, 0, 20) if self.chance(0.4) else ""))
        if kind == "notice":
            return self.mark(0, r.choice(["div", "div", "section", "dialog", "aside", "p"]), self.attrs("notice", 1),
                             self.text(60) if self.chance(0.5) else self.paragraphs(r.randint(1, 2), 0))
        if kind == "comment":
            tag, one = r.choice([("section", "div"), ("div", "div"), ("ol", "li"), ("ul", "li"), ("div", "article"), ("aside", "div")])
            talk = "".join(self.mark(0, one, self.attrs("comment", 0.5), r.choice([
                self.text(), self.paragraphs(r.randint(1, 3), 0), self.mark(0, "h4", "", self.text(3)) + self.paragraphs(1, 0)]))
                for _ in range(r.randint(1, 5)))
            return self.mark(0, tag, self.attrs("comment", 1), (self.mark(0, "h2", "", self.text(3)) if self.chance(0.5) else "") + talk)
        if kind == "share":
            return self.mark(0, r.choice(["div", "ul", "p"]), self.attrs("share", 1), self.text(6))
        inner = r.choice([f"<label>{self.text(3)}</label><input>", self.paragraphs(1, 0, 25), self.text(12)])
        return self.mark(0, "form", self.attrs("form", 0.5), inner + (self.mark(0, "button", "", self.text(2)) if self.chance(0.6) else ""))

    def article(self):
        r = self.random
        parts = [self.mark(1, r.choice(["h1", "h1", "h2"]), "", self.text(12))] if self.chance(0.85) else []
        if self.chance(0.2):                 # next to nothing
            parts.append(self.paragraphs(1, 1, 8))
        else:
            parts += self.sections(r.choice([1, 1, 2, 3, 4, 6, 8, 12]))
        for kind, p in (("ad", 0.2), ("share", 0.15), ("notice", 0.08), ("form", 0.1), ("side", 0.1), ("comment", 0.1)):
            if self.chance(p):
                parts.insert(r.randint(0, len(parts)), self.junk(kind))
        tag, attrs = r.choice([("article", ""), ("article", self.attrs("body")), ("main", ""), ("main", self.attrs("body")),
                               ("div", self.attrs("body", 1)), ("div", self.attrs("body", 1)), ("section", self.attrs("body", 1)), ("div", "")])
        inner = "".join(parts)
        if self.chance(0.2):
            inner = self.mark(1, "div", self.attrs("body", 0.6), inner)
        return self.mark(1, tag, attrs, inner)

    def sections(self, n):
        r, parts = self.random, []
        for _ in range(n):
            roll = r.random()
            if roll < 0.75:
                parts.append(self.paragraphs(1, 1, r.choice([None, None, None, 8, 4])))
            elif roll < 0.82:
                parts.append(self.mark(1, r.choice(["h2", "h3"]), "", self.text(8)))
            elif roll < 0.88:
                items = "".join(self.mark(1, "li", "", self.inline(self.text(30))) for _ in range(r.randint(2, 5)))
                parts.append(self.mark(1, r.choice(["ul", "ol"]), "", items))
            elif roll < 0.92:
                parts.append(self.mark(1, "blockquote", "", self.paragraphs(1, 1) if self.chance(0.5) else self.text()))
            elif roll < 0.95:
                rows = "".join(self.mark(1, "tr", "", "".join(self.mark(1, "td", "", self.text(5)) for _ in range(3))) for _ in range(3))
                parts.append(self.mark(1, "table", "", rows))
            elif roll < 0.97:
                parts.append(self.mark(1, "pre", "", self.text(20)))
            else:
                parts.append(self.mark(1, "div", "", self.text()))
        return parts

    def page(self) -> str:
        top = [self.junk(k) for k, p in (("head", 0.5), ("nav", 0.7), ("notice", 0.35), ("ad", 0.5), ("form", 0.2)) if self.chance(p)]
        bottom = [self.junk(k) for k, p in (("share", 0.25), ("comment", 0.4), ("side", 0.4), ("ad", 0.2), ("form", 0.25),
                                            ("notice", 0.2), ("nav", 0.15)) if self.chance(p)]
        self.random.shuffle(top)
        self.random.shuffle(bottom)
        middle = self.article()
        if self.chance(0.4):
            cut = self.random.randint(0, len(bottom))
            side = self.junk("side") if self.chance(0.4) else ""
            middle = self.mark(1, self.random.choice(["div", "main", "section"]), self.random.choice(
                ["", ' class="wrap"', ' id="page"', ' class="container"']), side + middle + "".join(bottom[:cut]))
            bottom = bottom[cut:]
        end = self.junk("foot") if self.chance(0.8) else ""
        return "<body>" + "".join(top) + middle + "".join(bottom) + end + "</body>"


_LABEL = re.compile(r' data-k="([01])"')


def train(texts: Sequence[str], pages: int = TRAIN_PAGES, seed: int = 11) -> boosted.Forest:
    maker, features, labels, weights = Maker(texts, seed), [], [], []
    for _ in range(pages):
        html = maker.page()
        told = [1] + [int(x) for x in _LABEL.findall(html)]
        root, nodes = parse(_LABEL.sub("", html))
        if len(nodes) != len(told):          # markup that the parser joined
            continue
        features.append(node_features(root, nodes))
        labels.append(np.array(told, np.float64))
        weights.append(np.array([1 + np.log1p(sum(len(t) for _, t in x.runs)) / 4 for x in nodes]))
    return boosted.fit(np.concatenate(features), np.concatenate(labels), np.concatenate(weights))


def _sample_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for html in batch.column(0).to_pylist():
            _, nodes = parse(html or "")
            texts = [" ".join(t.split()) for n in nodes for _, t in n.runs]
            out += [" ".join(t.split()[:SAMPLE_WORDS]) for t in texts if len(t) > LEAST_CHARS][:SAMPLE_TEXTS]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["text"])


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> boosted.Forest:
    """Fits the trees on texts of at most ``SAMPLE_PAGES`` pages, those with the
    smallest hashes of their ids, ``SAMPLE_TEXTS`` texts of a page and
    ``SAMPLE_WORDS`` words of a text at most; texts of no more than
    ``LEAST_CHARS`` characters are left out.  Only the fit is so bounded.  Of rows that repeat an id (or have none) the one
    with the smallest hash of the page counts."""
    ids = pages.select(F.col(f"`{id_col}`").alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PAGES)
    sample = pages.select(F.col(f"`{html_col}`").alias("html"), F.col(f"`{id_col}`").alias("page"))
    one = (sample.where(F.col("html").isNotNull()).join(F.broadcast(ids), F.col("page").eqNullSafe(F.col("id")))
           .groupBy("page").agg(F.min_by("html", F.struct(F.xxhash64("html"), "html")).alias("html")))
    rows = one.select("html").mapInArrow(_sample_texts, "text string")
    return train(sorted(r["text"] for r in rows.collect()))


def extract_pages(pages: DataFrame, forest: boosted.Forest, html_col: str = "html", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, text and n_chars of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, RUN_PAGES):
                part = batch.slice(a, RUN_PAGES)
                texts = extract(part.column(len(keep)).to_pylist(), forest)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").alias("__html"))
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long")
