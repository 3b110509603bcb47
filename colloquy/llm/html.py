"""Main text of web pages by a tree-structured graphical model over the DOM.

A page becomes a tree of block elements, with each run of text as a leaf.  Every node is content or not: its own potential comes
from features (element, words of class, id and role, text length, share of link text, punctuation), and an edge's potential
from the two states and the child's element.  Sum-product messages go up the tree, level by level, and down again, for all pages of a
batch at once; the marginals that result decide which runs are content.  Weights maximise the likelihood of labelled pages: the
gradient is observed minus expected counts, the latter from the same messages.  The labelled pages are made by
labelled_pages(), many layouts of articles among menus, headers, footers, sidebars, notices, adverts, forms and comments.

Rules: null and empty html give empty text; scripts, styles and what a browser doesn't show are never text; character references
are decoded, white space within a block is one space, blocks are joined by two line feeds in page order; cut-off tags at the
end of a page are dropped, and elements left open end with it.  Rows stay as they are; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import column, give_back, shared, slices, table

TRAIN_PAGES, STEPS, RATE = 500, 80, 0.3
CUT = 0.5
SCHEMA = "page_id long, url string, text string, n_chars long"

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role|aria-label|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
#: Elements whose contents are passed over as a whole.
_SKIP = {"script", "style", "title", "noscript", "template", "textarea", "select", "button", "iframe", "svg", "canvas", "audio", "video", "noembed", "noframes", "datalist"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Block elements: each is a node of the tree.
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag ends the open element named first on the way to one of the others.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"})}
_SCOPE = {"td", "th", "caption", "table", "html", "button"}
_KEEPS_P = {"html", "head", "body", "tbody", "td", "tfoot", "th", "thead", "tr", "caption"}
#: What the words of class, id and role say.
_GROUPS = [
    ("nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "tabs", "topbar"),
    ("sidebar", "side", "aside", "rail", "widget", "widgets", "complementary"),
    ("ad", "ads", "advert", "adverts", "advertisement", "adsense", "adbox", "sponsor", "sponsored", "promo", "promoted", "promotion", "banner"),
    ("comment", "comments", "commentlist", "reply", "replies", "respond", "discussion", "disqus", "review", "reviews"),
    ("footer", "foot", "copyright", "legal", "colophon", "contentinfo"),
    ("header", "head", "masthead", "logo", "branding"),
    ("cookie", "cookies", "consent", "notice", "notices", "alert", "popup", "modal", "overlay", "dialog", "gdpr", "warning", "message", "status", "toast", "paywall"),
    ("share", "sharing", "social", "follow", "related", "recommended", "recommendations", "recent", "popular", "trending", "more", "teaser", "tags"),
    ("form", "search", "subscribe", "subscription", "newsletter", "signup", "login", "register", "contact"),
    ("content", "article", "post", "entry", "story", "main", "text", "body", "prose", "maincontent", "articlebody"),
]
_GROUP_OF = {w: i for i, ws in enumerate(_GROUPS) for w in ws}
_TAGS = ["#run", "p", "div", "section", "article", "main", "h1", "h2", "h3", "ul", "li", "table", "tr", "td", "nav", "header", "footer", "aside", "form", "blockquote", "pre", "figure", "figcaption", "body", "html", "head", "dialog", "details", "address", "fieldset", "#other"]
_TAG_AT = {t: i for i, t in enumerate(_TAGS)} | {"h4": 8, "h5": 8, "h6": 8, "ol": 9, "dl": 9, "menu": 9, "dd": 10, "dt": 10, "th": 13, "tbody": 11, "thead": 11, "tfoot": 11, "caption": 22, "legend": 29, "label": 29, "summary": 27}
_N_TAGS, _N_GROUPS = len(_TAGS), len(_GROUPS)
#: Feature columns: element, own groups, length, link share, punctuation, flags, region.
_AT_GROUP = _N_TAGS
_AT_LENGTH = _AT_GROUP + _N_GROUPS
_AT_LINK = _AT_LENGTH + 9
_AT_DOTS = _AT_LINK + 4
_AT_FLAG = _AT_DOTS + 4
_AT_REGION = _AT_FLAG + 4
N_FEATURES = _AT_REGION + 3


_CONTENT = len(_GROUPS) - 1
_ASIDE = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "search"}


@dataclass
class Tree:
    """Nodes in page order: parents come before children."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    groups: list[tuple[int, ...]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)  # of runs
    linked: list[int] = field(default_factory=list)  # of a run's characters, those in links
    hidden: list[bool] = field(default_factory=list)
    region: list[int] = field(default_factory=list)  # 0: none yet, 1: in an article by its names, 2: in something else

    def add(self, parent: int, tag: str, groups: tuple[int, ...] = (), text: str | None = None, linked: int = 0, hidden: bool = False) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tag.append(tag)
        self.groups.append(groups)
        self.text.append(text)
        self.linked.append(linked)
        self.hidden.append(hidden or (parent >= 0 and self.hidden[parent]))
        region = self.region[parent] if parent >= 0 else 0
        if region < 2 and (tag in _ASIDE or any(g != _CONTENT for g in groups)) and tag not in ("body", "html"):
            region = 2 if tag != "header" or region == 0 else region
        elif region == 0 and (tag in ("article", "main") or _CONTENT in groups):
            region = 1
        self.region.append(region)
        return len(self.parent) - 1


_GROUP_CACHE: dict[str, tuple[int, ...]] = {}


def _groups(attrs: str) -> tuple[int, ...]:
    if "=" not in attrs:
        return ()
    key = " ".join(_ATTRIBUTE.findall(attrs))
    if not key:
        return ()
    found = _GROUP_CACHE.get(key)
    if found is None:
        spread = re.sub(r"([a-z])([A-Z])", r"\1 \2", key).lower()
        found = tuple(sorted({_GROUP_OF[w] for w in re.findall(r"[a-z]+", spread) if w in _GROUP_OF}))
        if len(_GROUP_CACHE) > 50_000:
            _GROUP_CACHE.clear()
        _GROUP_CACHE[key] = found
    return found


def parse(page: str) -> Tree:
    """The tree of block elements and text runs of a page; never fails."""
    tree = Tree()
    open_: list[tuple[str, int]] = [("#root", tree.add(-1, "body"))]
    pieces: list[str] = []
    links: list[int] = [0, 0]  # open links, characters in links of this run
    lower = None

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                tree.add(open_[-1][1], "#run", (), text, min(links[1], len(text)))
            pieces.clear()
        links[1] = 0

    def take(raw: str) -> None:
        if raw:
            text = entities.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if links[0]:
                links[1] += len(text)

    def close(names: set[str], stop: set[str]) -> None:
        for i in range(len(open_) - 1, 0, -1):
            if open_[i][0] in names:
                flush()
                del open_[i:]
                return
            if open_[i][0] in stop:
                return

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            take(page[at:])
            break
        take(page[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        attrs = m["attrs"] or m["attrs2"] or ""
        if m["end"] or m["end2"]:
            if tag == "a":
                links[0] = max(0, links[0] - 1)
            elif tag in _BLOCK:
                close({tag}, _SCOPE - {tag} if tag not in ("body", "html", "table") else set())
            elif tag == "br":
                pieces.append(" ")
            continue
        if tag in _SKIP:
            if not attrs.endswith("/"):
                if lower is None:
                    lower = page.lower() if page.isascii() else re.sub(r"[A-Z]", lambda c: c[0].lower(), page)
                end = lower.find("</" + tag, at)
                at = len(page) if end < 0 else end
                if end >= 0:
                    closing = page.find(">", end)
                    at = len(page) if closing < 0 else closing + 1
            pieces.append(" ") if tag in ("textarea", "select", "button") else None
        elif tag == "a":
            links[0] = 1
        elif tag == "br":
            pieces.append(" ")
        elif tag == "hr":
            close({"p"}, _SCOPE)
            flush()
        elif tag in _BLOCK and tag not in _VOID:
            flush()
            if tag in _ENDS:
                close(*_ENDS[tag])
            elif tag not in _KEEPS_P:
                close({"p"}, _SCOPE)
                if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                    close({"h1", "h2", "h3", "h4", "h5", "h6"}, _BLOCK - {"h1", "h2", "h3", "h4", "h5", "h6"})
            links[0] = 0 if tag in ("article", "body", "main") else links[0]
            node = tree.add(open_[-1][1], tag, _groups(attrs), hidden=bool(attrs) and _HIDDEN.search(attrs) is not None)
            open_.append((tag, node))
    flush()
    return tree


_COPYRIGHT = re.compile(r"©|\(c\) ?\d{4}|all rights reserved", re.I)


@dataclass
class Forest:
    """Trees put together: features and links for message passing, by level."""

    x: np.ndarray  # nodes x features
    kind: np.ndarray  # the element, which chooses the edge potential
    parent: np.ndarray
    levels: list[np.ndarray]  # nodes by depth, roots first

    @classmethod
    def of(cls, trees: list[Tree]) -> Forest:
        first = np.concatenate([[0], np.cumsum([len(t.parent) for t in trees])])
        total = int(first[-1])
        parent = np.fromiter((p + f if p >= 0 else -1 for t, f in zip(trees, first, strict=False) for p in t.parent), np.int64, total)
        depth = np.fromiter((d for t in trees for d in t.depth), np.int64, total)
        kind = np.fromiter((_TAG_AT.get(g, _N_TAGS - 1) for t in trees for g in t.tag), np.int64, total)
        texts = [s for t in trees for s in t.text]
        chars = np.fromiter((len(s) if s else 0 for s in texts), np.float64, total)
        linked = np.fromiter((n for t in trees for n in t.linked), np.float64, total)
        dots = np.fromiter((sum(map(s.count, ".,;:!?")) if s else 0 for s in texts), np.float64, total)
        mark = np.fromiter((bool(s) and len(s) < 400 and _COPYRIGHT.search(s) is not None for s in texts), np.float64, total)
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if total else []
        for level in reversed(levels[1:]):  # an element has the text of its runs
            for v in (chars, linked, dots):
                np.add.at(v, parent[level], v[level])
        run = kind == 0
        words = np.maximum(chars / 6, 1)
        x = np.zeros((total, N_FEATURES), np.float32)
        every = np.arange(total)
        x[every, kind] = 1
        rows = [(i + f, g) for t, f in zip(trees, first, strict=False) for i, gs in enumerate(t.groups) for g in gs]
        if rows:
            r, g = np.array(rows).T
            x[r, _AT_GROUP + g] = 1
        x[every, _AT_LENGTH + np.clip(np.log2(np.maximum(chars, 1)).astype(int) - 2, 0, 8)] = 1
        share = linked / np.maximum(chars, 1)
        x[every, _AT_LINK + (share > 0.01).astype(int) + (share > 0.3) + (share > 0.7)] = 1
        x[every, _AT_DOTS + (dots > 0).astype(int) + (dots / words > 0.04) + (dots / words > 0.25)] = 1
        x[:, _AT_FLAG] = mark
        x[:, _AT_FLAG + 1] = np.fromiter((h for t in trees for h in t.hidden), np.float64, total)
        x[:, _AT_FLAG + 2] = (kind == _TAG_AT["li"]) & (share > 0.7)
        x[:, _AT_FLAG + 3] = run & (depth <= 2)
        x[every, _AT_REGION + np.fromiter((r for t in trees for r in t.region), np.int64, total)] = 1
        return cls(x, kind, parent, levels)


class Model:
    """Potentials: own[f] speaks for content; edge[kind, parent's state, child's state]."""

    def __init__(self):
        self.own, self.edge = np.zeros(N_FEATURES), np.zeros((_N_TAGS, 2, 2))
        self.edge += np.array([[0.5, -0.5], [-0.5, 0.5]])

    def messages(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of nodes (nodes x 2) and edges (nodes x parent's state x own state; roots have none)."""
        score = forest.x @ self.own
        local = np.stack([-score / 2, score / 2], 1)
        edge = self.edge[forest.kind]
        up = local.copy()  # local potential and the messages of all children
        sent = np.zeros_like(local)
        for level in reversed(forest.levels[1:]):
            sent[level] = np.logaddexp(edge[level, :, 0] + up[level, None, 0], edge[level, :, 1] + up[level, None, 1])
            np.add.at(up, forest.parent[level], sent[level])
        down = np.zeros_like(local)
        pair = np.zeros((len(score), 2, 2))
        for level in forest.levels[1:]:
            above = forest.parent[level]
            rest = down[above] + up[above] - sent[level]  # what the parent knows without this child
            joint = rest[:, :, None] + edge[level]
            down[level] = np.logaddexp(joint[:, 0], joint[:, 1])
            full = joint + up[level][:, None, :]
            full -= full.max((1, 2), keepdims=True)
            p = np.exp(full)
            pair[level] = p / p.sum((1, 2), keepdims=True)
        belief = up + down
        belief -= belief.max(1, keepdims=True)
        p = np.exp(belief)
        return p / p.sum(1, keepdims=True), pair

    def fit(self, forest: Forest, label: np.ndarray, steps: int = STEPS, rate: float = RATE, decay: float = 2e-4) -> None:
        """Adagrad on the likelihood of labelled nodes."""
        child = np.flatnonzero(forest.parent >= 0)
        seen = np.zeros((len(label), 2, 2))
        seen[child, label[forest.parent[child]], label[child]] = 1
        squares = [np.full(self.own.shape, 1e-8), np.full(self.edge.shape, 1e-8)]
        n = len(label)
        for _ in range(steps):
            node, pair = self.messages(forest)
            slope = forest.x.T @ (label - node[:, 1]) / n - decay * self.own
            difference = np.zeros_like(self.edge)
            np.add.at(difference, forest.kind[child], seen[child] - pair[child])
            difference = difference / n - decay * self.edge
            for which, (value, g) in enumerate(((self.own, slope), (self.edge, difference))):
                squares[which] += g**2
                value += rate * g / np.sqrt(squares[which])

    def main_text(self, pages: list[str | None], cut: float = CUT) -> list[str]:
        trees = [parse(p) if p else Tree() for p in pages]
        forest = Forest.of(trees)
        content = self.messages(forest)[0][:, 1] if len(forest.parent) else np.zeros(0)
        out, at = [], 0
        for tree in trees:
            own = content[at : at + len(tree.parent)]
            at += len(tree.parent)
            out.append("\n\n".join(t for t, p, h in zip(tree.text, own, tree.hidden, strict=True) if t and p >= cut and not h))
        return out


#: Words of the made pages' class attributes: (element names, class words) for each kind of thing that isn't the article.
_NOISE = {
    "menu": (("nav", "div", "ul", "div"), ("nav", "menu", "navbar", "breadcrumb", "topbar", "")),
    "header": (("header", "div"), ("header", "masthead", "branding", "site-header")),
    "footer": (("footer", "div"), ("footer", "site-footer", "copyright", "colophon")),
    "sidebar": (("aside", "div"), ("sidebar", "side", "widget", "right-rail")),
    "advert": (("div", "aside", "section"), ("ad", "ads", "advert", "sponsored", "promo", "banner ad")),
    "notice": (("div", "section", "dialog", "p"), ("cookie-notice", "notice", "alert", "consent", "popup", "paywall-message")),
    "form": (("form", "div"), ("newsletter", "subscribe-form", "search-form", "login", "contact-form")),
    "comments": (("section", "div", "ol"), ("comments", "comment-list", "reply", "discussion", "reviews")),
    "related": (("div", "section"), ("related", "share", "recommended", "social", "popular", "tags")),
}
_SYLLABLES = "an be co de er fo gi ha in jo ka le mo na or pa qu re st ti un ve wi ya zu".split()


def _words(rng: random.Random, low: int, high: int, dots: float = 0.12) -> str:
    """Invented prose."""
    out = []
    for i in range(rng.randint(low, high)):
        w = "".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4)))
        out.append((w.title() if i == 0 else w) + (rng.choice(".,") if rng.random() < dots else ""))
    return " ".join(out) + ("." if dots and rng.random() < 0.8 else "")


def labelled_pages(n: int, seed: int = 7) -> list[tuple[str, set[str]]]:
    """n invented pages, each with the texts of its article's runs; every page has its own mix of layout and noise."""
    rng = random.Random(seed)
    out = []
    for number in range(n):
        content: set[str] = set()
        marker = 0

        def say(low: int, high: int, dots: float = 0.12, own: bool = False) -> str:
            nonlocal marker
            marker += 1
            text = f"{_words(rng, low, high, dots)} q{marker}"  # noqa: B023
            if own:
                content.add(text)  # noqa: B023
            return text

        def noise(kind: str) -> str:
            elements, names = _NOISE[kind]
            element, name = rng.choice(elements), rng.choice(names)
            semantic = element in ("nav", "header", "footer", "aside", "form", "dialog")
            attrs = "" if (semantic and rng.random() < 0.6) else f' {rng.choice(["class", "id", "class"])}="{name}"' if name else ""
            link = lambda: f'<a href="/{rng.randint(1, 99)}">{say(1, 3, 0.05)}</a>'  # noqa: E731, B023
            if kind == "menu":
                inner = "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 9)))
                inner = inner if element == "ul" else f"<ul>{inner}</ul>" if rng.random() < 0.7 else " | ".join(link() for _ in range(rng.randint(3, 8)))
            elif kind == "comments":
                item = "li" if element == "ol" else rng.choice(("div", "p", "div", "p", "article"))
                inner = "".join(f"<{item}>{say(4, 50)}</{item}>" for _ in range(rng.randint(1, 5)))
                inner = inner if element == "ol" else f"<h3>{say(1, 3, 0)}</h3>" + inner
            elif kind == "form":
                inner = f"<label>{say(1, 4, 0)}</label><input name=q><p>{say(3, 14)}</p><button>{say(1, 2, 0)}</button>"
            elif kind in ("related", "sidebar"):
                inner = f"<h3>{say(1, 4, 0)}</h3>" + "".join(rng.choice((f"<p>{say(4, 30)}</p>", f"<li>{link()}</li>", f"<div>{link()}</div>")) for _ in range(rng.randint(1, 5)))  # noqa: B023
            elif kind == "footer":
                inner = rng.choice((f"&copy; site.example &middot; {say(2, 20)}", f"<p>&copy; 2020 {say(1, 6)}</p>", f"<p>{say(2, 15)}</p><ul><li>{link()}</li></ul>"))
            elif kind == "header":
                inner = rng.choice((f"<div>{say(1, 5, 0)}</div>", f"<p>{say(2, 8, 0)}</p>", say(1, 5, 0), f'<h2>{say(1, 4, 0)}</h2><a href="/">{say(1, 2, 0)}</a>'))
            else:
                inner = rng.choice((say(3, 40), f"<p>{say(3, 40)}</p>", f"{say(2, 12)} {link()}", f"<h4>{say(1, 4, 0)}</h4><p>{say(4, 30)}</p>"))
            return f"<{element}{attrs}>{inner}</{element}>"

        def block() -> str:
            kind = rng.random()
            if kind < 0.62:
                text = say(1, rng.choice((3, 12, 60, 140)), rng.choice((0.02, 0.1, 0.15)), True)
                return rng.choice((f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br></p>", f"<p><b>{text}<br>", f"<p>{text}</p>\n"))
            if kind < 0.74:
                h = rng.choice(("h2", "h3"))
                return f"<{h}>{say(1, 9, 0, True)}</{h}>"
            if kind < 0.86:
                return "<ul>" + "".join(f"<li>{say(2, 25, 0.1, True)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
            if kind < 0.91:
                return f"<blockquote><p>{say(5, 40, 0.12, True)}</p></blockquote>"
            if kind < 0.95:
                return f"<pre>{say(3, 25, 0.2, True)}</pre>"
            return "<table>" + "".join(f"<tr><td>{say(1, 5, 0.02, True)}</td><td>{say(1, 5, 0.02, True)}</td></tr>" for _ in range(rng.randint(1, 4))) + "</table>"

        title = say(2, 12, 0.02, True)
        body = (f"<h1>{title}</h1>" if rng.random() < 0.85 else f"<h2>{title}</h2>") + "".join(block() for _ in range(rng.randint(1, 9)))
        if rng.random() < 0.25:
            body += noise(rng.choice(("related", "comments", "advert", "form")))
        if rng.random() < 0.15:
            body = noise(rng.choice(("advert", "notice"))) + body
        layout = rng.random()
        if layout < 0.4:
            body = f"<article>{body}</article>"
        elif layout < 0.55:
            body = f"<main>{body}</main>"
        elif layout < 0.7:
            body = f'<div class="{rng.choice(("content", "post", "entry-content", "story", "main-text"))}">{body}</div>'
        elif layout < 0.8:
            body = f'<main><article class="post">{body}</article></main>'
        elif layout < 0.9:
            body = f"<div>{body}</div>"
        if layout >= 0.97:
            out.append((f"<p>{title}</p>", {title}) if rng.random() < 0.5 else (title, {title}))
            continue
        before = [noise(k) for k in ("header", "menu", "notice", "advert") if rng.random() < 0.55]
        after = [noise(k) for k in ("related", "comments", "sidebar", "advert", "form", "notice", "footer") if rng.random() < 0.4]
        rng.shuffle(before)
        if rng.random() < 0.3:
            body = f'<div id="{rng.choice(("wrapper", "page", "container"))}">{body}{"".join(after[:1])}</div>'
            after = after[1:]
        page = f"<!DOCTYPE html><html><head><title>{number}</title></head><body>{''.join(before)}{body}{''.join(after)}</body></html>"
        if rng.random() < 0.1:
            page = page[: -rng.randint(1, 20)]
        out.append((page, content))
    return out


def train(pages: list[tuple[str, set[str]]] | None = None) -> Model:
    """Learn from (html, texts of content runs): a run is content if its text is one of them, an element if at least half of
    its text is (body and html: all of it)."""
    pages = labelled_pages(TRAIN_PAGES) if pages is None else pages
    trees = [parse(p) for p, _ in pages]
    forest = Forest.of(trees)
    label: list[int] = []
    for tree, (_, content) in zip(trees, pages, strict=True):
        good, every = np.zeros(len(tree.parent)), np.zeros(len(tree.parent))
        for i, text in enumerate(tree.text):
            if text:
                every[i] = len(text)
                good[i] = len(text) * (text in content)
        for i in range(len(tree.parent) - 1, 0, -1):
            good[tree.parent[i]] += good[i]
            every[tree.parent[i]] += every[i]
        share = good / np.maximum(every, 1)
        label += [int(share[i] >= (0.5 if tree.tag[i] not in ("body", "html") else 0.99)) for i in range(len(tree.parent))]
    model = Model()
    model.fit(forest, np.array(label, np.int64))
    return model


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html")
    held = shared(pages.sparkSession, model or train())

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html", 1_000_000):
                texts = held.value.main_text(column(part, "html"))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
        give_back()

    return pages.mapInArrow(run, SCHEMA)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
