"""Main text of web pages by gradient-boosted trees over DOM nodes.

A tolerant parser turns a page into nodes; each element gets features of its tag, its attribute tokens, its
depth, its subtree (text and link density, words a block) and its siblings (how many there are, and how many
are built alike). The tokens of class, id and role are hashed; what a token says is learned from the labels,
as the log-odds of nodes that carry it, so no list of names is needed and a name that is met on wrappers of
articles as well says little. Boosted trees
(depth-limited regression trees on binned features, logistic loss; trained here) give each node log-odds
of being part of the article.

Decoding is hierarchical: a node that is dropped takes its whole subtree with it. Bottom-up dynamic
programming finds the choice of highest total log-odds under that rule, so no kept node lies inside a
dropped one. Scripts, styles, forms' controls and the head never hold text.

Training takes a bounded sample of pages (`SAMPLE_PAGES`). Semantic tags alone label them; each page is also
laid out anew in several ways (sections without semantic tags, menus, sidebars, notices, adverts, forms,
comments, made of texts of the sample; with telling, misleading or meaningless names, names of other parts on
the body and on wrappers, parts in a table), where the labels are known from the construction. The model is
small and goes to the tasks with the function.

Defined cases: null and empty pages give an empty text; text outside any element counts as text of the
body; unclosed and crossed tags are closed as their parents close; repeated rows give the same text twice;
an empty table gives an empty result and trains nothing; other columns are not looked at.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.llm.common import ROW, with_row

SAMPLE_PAGES = 300
#: Element names of HTML by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(["script", "style", "textarea", "title", "noscript", "template", "iframe", "svg"])
#: Of these, elements that hold markup: one that is never closed holds nothing.
RAW_MARKUP = frozenset(["noscript", "template", "svg"])
NO_TEXT = RAW | frozenset(["head", "select", "option", "button", "input", "object", "canvas"])
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i img ins kbd label mark q s samp small span strong sub sup time tt u var wbr".split())
CLOSED_BY = {
    "p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
SCOPES = frozenset("article aside blockquote body div footer form header main nav ol section table td th ul".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?[A-Za-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>?|[^<]+|<", re.S)
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s=\"'/<>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_ATTRIBUTE_WORD = re.compile(r"[A-Za-z]+")
_BLANK = re.compile(r"\s+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_SCRIPT_MARK = re.compile(r"<!--(?!-*>)|-->|<(/?)script(?=[\s/>])", re.I)


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    tokens: tuple[str, ...] = ()
    children: list = field(default_factory=list)  # child nodes by number, own texts as strings
    label: int = 0


def _plain(text: str) -> str:
    """Text with its character references decoded."""
    marks = text.count("&")
    if not marks:
        return text
    if marks == text.count("&amp;"):
        return text.replace("&amp;", "&")
    return html.unescape(text)


def _after_raw(page: str, tag: str, at: int) -> int:
    """Where the closing tag of a RAW element begins whose content begins at `at`.

    As in HTML, a script inside a comment inside a script has a closing tag of its own.
    """
    if tag == "script":
        comment = inner = False
        for mark in _SCRIPT_MARK.finditer(page, at):
            if mark[1] is None:
                comment, inner = mark[0] == "<!--", inner and mark[0] == "<!--"
            elif not mark[1]:
                inner = comment
            elif inner:
                inner = False
            else:
                return mark.start()
        return len(page)
    found = _RAW_END[tag].search(page, at)
    if found:
        return found.start()
    return at if tag in RAW_MARKUP else len(page)


def parse(page: str) -> list[Node]:
    """Nodes in page order; node 0 is the root. Never fails."""
    nodes = [Node("#root", -1, 0)]
    open_ = [0]
    rest = _TOKEN.finditer(page)
    while found := next(rest, None):
        token = found[0]
        if token[0] != "<" or len(token) == 1 or (token[1] not in "/!?" and not token[1].isalpha()):
            nodes[open_[-1]].children.append(_plain(token))
            continue
        if token[1] in "!?":
            if token.startswith("<![CDATA["):
                nodes[open_[-1]].children.append(token[9:].removesuffix("]]>"))
            continue
        tag = _NAME.match(token)[1].lower()
        if token[1] == "/":
            for k in range(len(open_) - 1, 0, -1):
                name = nodes[open_[k]].tag
                if name == tag:
                    del open_[k:]
                    break
                if name in SCOPES and tag in INLINE:
                    break
            continue
        for k in range(len(open_) - 1, 0, -1):
            name = nodes[open_[k]].tag
            if tag in CLOSED_BY.get(name, ()):
                del open_[k:]
                break
            if name in SCOPES:
                break
        tokens: tuple[str, ...] = ()
        if "=" in token:
            tokens = tuple(
                t for name, *value in _ATTRIBUTE.findall(token) if name.lower() in ("class", "id", "role", "itemprop")
                for word in "".join(value).lower().split() for t in attribute_tokens(word)
            )
        nodes.append(Node(tag, open_[-1], len(open_), tokens))
        nodes[open_[-1]].children.append(len(nodes) - 1)
        if tag in VOID or token.endswith("/>"):
            continue
        if tag in RAW:
            rest = _TOKEN.finditer(page, _after_raw(page, tag, found.end()))
        else:
            open_.append(len(nodes) - 1)
    return nodes


#: Bins that attribute tokens are hashed to.
TOKEN_BINS = 2048


@lru_cache(1 << 14)
def attribute_tokens(word: str) -> tuple[str, ...]:
    """The parts of a name, and the whole name where it has several."""
    parts = tuple(_ATTRIBUTE_WORD.findall(word))
    return (*parts, word) if len(parts) > 1 else parts


@lru_cache(1 << 14)
def _bin(token: str) -> int:
    return zlib.crc32(token.encode()) % TOKEN_BINS


def token_odds(examples: list[list[Node]], doubt: float = 4.0) -> np.ndarray:
    """Log-odds that a node with a token is part of the article, by bin; rare tokens stay close to 0."""
    kept, all_ = np.zeros(TOKEN_BINS), np.zeros(TOKEN_BINS)
    for nodes in examples:
        # A page counts a token once for each label, however often a part repeats.
        for b, label in {(_bin(t), x.label) for x in nodes for t in x.tokens}:
            all_[b] += 1
            kept[b] += label
    return np.log((kept + doubt) / (all_ - kept + doubt))


TAGS = (
    "article main section div p nav header footer aside form ul ol li table td h1 h2 h3 blockquote pre a span b figure body #root".split()
)
_TAG_CODE = {t: k + 1 for k, t in enumerate(TAGS)}
FEATURES = (
    "is_content_tag", "is_boiler_tag", "is_heading", "is_paragraph", "is_list", "is_container", "tag_code", "lowest_token", "highest_token",
    "above_content", "above_boiler", "above_lowest_token", "alike", "parent_alike", "parts", "depth", "place", "siblings", "characters", "share_of_page", "link_share", "links", "blocks",
    "words_a_block", "controls", "share_of_parent", "parent_share", "parent_link_share", "parent_words_a_block", "parent_stops", "before_share", "after_share", "longest_block", "own_characters", "stops",
)
_CONTENT_TAGS, _BOILER_TAGS = frozenset(["article", "main"]), frozenset(["nav", "header", "footer", "aside", "form", "menu", "dialog"])
_HEADINGS, _PARAGRAPHS = frozenset(["h1", "h2", "h3"]), frozenset(["p", "blockquote", "pre"])
_LISTS, _CONTAINERS = frozenset(["ul", "ol", "li", "table"]), frozenset(["div", "section"])
_CONTROLS = frozenset(["input", "button", "select", "textarea", "label"])


def features(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """One row of FEATURES per node; `odds` is a result of `token_odds`."""
    n = len(nodes)
    own, linked, links, blocks, controls, stops = ([0.0] * n for _ in range(6))
    for k, node in enumerate(nodes):
        if node.tag in NO_TEXT:
            continue
        for c in node.children:
            if c.__class__ is str:
                text = c.strip()
                own[k] += len(text)
                stops[k] += text.count(". ") + text.count("? ") + text.count("! ") + text.endswith(".")
    total, longest = own.copy(), [0.0] * n
    for k in range(n - 1, 0, -1):
        tag, up = nodes[k].tag, nodes[k].parent
        if tag == "a":
            linked[k], links[k] = total[k], links[k] + 1
        if tag in _CONTROLS:
            controls[k] += 1
        if total[k] and not blocks[k] and tag not in INLINE and tag not in VOID:
            blocks[k], longest[k] = 1.0, total[k]
        total[up] += total[k]
        linked[up] += linked[k]
        links[up] += links[k]
        blocks[up] += blocks[k]
        controls[up] += controls[k]
        stops[up] += stops[k]
        if longest[k] > longest[up]:
            longest[up] = longest[k]
    page = total[0] or 1.0
    siblings, parts = [0] * n, [()] * n
    for k in range(n - 1, 0, -1):
        siblings[nodes[k].parent] += 1
        if nodes[k].tag not in VOID:
            parts[nodes[k].parent] += (nodes[k].tag,)
    # Elements of one parent with the same tag and the same child tags, if they have any.
    shapes = [(x.parent, x.tag, frozenset(p)) for x, p in zip(nodes, parts)]
    many = Counter(x for x, p in zip(shapes, parts) if p)
    alike = [many[x] if p else 0 for x, p in zip(shapes, parts)]
    above, seen, out = [(0, 0, 0.0)] * n, [0] * n, []
    for k, node in enumerate(nodes):
        tag, up = node.tag, max(node.parent, 0)
        said = [odds[_bin(t)] for t in node.tokens] or (0.0,)
        least, most = min(said), max(said)
        is_content, is_boiler = tag in _CONTENT_TAGS, tag in _BOILER_TAGS
        place, beside = seen[up], siblings[up] or 1
        over = above[up] if k else (0, 0, 0.0)
        if k:
            seen[up] += 1
        chars = total[k]
        out.append((
            is_content, is_boiler, tag in _HEADINGS, tag in _PARAGRAPHS, tag in _LISTS, tag in _CONTAINERS, _TAG_CODE.get(tag, 0), least, most,
            over[0], over[1], over[2], alike[k], alike[up] if k else 0, len(parts[k]), node.depth, place, beside, chars, chars / page, linked[k] / (chars or 1), links[k], blocks[k], chars / (blocks[k] or 1),
            controls[k], chars / (total[up] or 1), total[up] / page, linked[up] / (total[up] or 1), total[up] / (blocks[up] or 1), stops[up] / (total[up] or 1) * 100, place / beside, (beside - place) / beside, longest[k], own[k], stops[k] / (chars or 1) * 100,
        ))
        # What holds most of the page says little about its parts.
        above[k] = (over[0] + is_content, over[1] + is_boiler, over[2] if chars > page / 2 else min(over[2], least))
    return np.array(out, float)


@dataclass
class BoostedTrees:
    """Depth-limited trees; arrays by tree and place in it (children of i: 2i+1, 2i+2)."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, self.feature[t, at]] > self.cut[t, at])
            out += self.value[t, at]
        return out


@dataclass
class PageModel:
    """The trees, and what attribute tokens say."""

    trees: BoostedTrees
    odds: np.ndarray

    def score(self, pages: list[list[Node]]) -> list[np.ndarray]:
        """Log-odds of the nodes of each page; the trees run over all of them at once."""
        rows = [features(p, self.odds) for p in pages]
        scores = np.split(self.trees.score(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
        return [_even(p, s) for p, s in zip(pages, scores)]


def _even(nodes: list[Node], scores: np.ndarray) -> np.ndarray:
    """Paragraphs of one parent with the same tag and attributes are judged together, by their mean."""
    groups: dict[tuple, list[int]] = {}
    for k, x in enumerate(nodes):
        if x.tag in _PARAGRAPHS:
            groups.setdefault((x.parent, x.tag, x.tokens), []).append(k)
    for group in groups.values():
        if len(group) > 1:
            scores[group] = scores[group].mean()
    return scores


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 5, rate: float = 0.2, bins: int = 32, least: float = 4.0) -> BoostedTrees:
    """Newton boosting on the logistic loss with histograms over quantile bins."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    prior = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
    base = float(np.log(prior / (1 - prior)))
    score = np.full(len(y), base)
    size, n, wide = 2 ** (depth + 1) - 1, x.shape[1], max(len(c) for c in cuts) + 1
    # Bins without a cut behind them are no place to divide at.
    able = np.arange(wide)[None, :] < np.array([len(c) for c in cuts])[:, None]
    place = np.arange(n) * wide + codes
    feature, cut, value = np.zeros((trees, size), np.int64), np.full((trees, size), np.inf), np.zeros((trees, size))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (y - p), weight * p * (1 - p) + 1e-9
        wide_g, wide_h = np.repeat(g, n), np.repeat(h, n)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            bins = (place + ((at - first) * (n * wide))[:, None]).ravel()
            sg, sh = (np.bincount(bins, w, many * n * wide).reshape(many, n, wide).cumsum(axis=2) for w in (wide_g, wide_h))
            whole_g, whole_h = sg[:, :1, -1:], sh[:, :1, -1:]
            gain = sg**2 / (sh + 1) + (whole_g - sg) ** 2 / (whole_h - sh + 1) - whole_g**2 / (whole_h + 1)
            gain[~(able[None] & (sh >= least / 4) & (whole_h - sh >= least / 4))] = -1
            best = gain.reshape(many, -1).argmax(axis=1)
            for k in np.flatnonzero(gain.reshape(many, -1).max(axis=1) > 1e-6):
                f, c = divmod(int(best[k]), wide)
                feature[t, first + k], cut[t, first + k] = f, cuts[f][c]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t, at]] > cut[t, at])
        leaf_g, leaf_h = np.bincount(at, g, size), np.bincount(at, h, size)
        value[t] = rate * leaf_g / (leaf_h + 1)
        score += value[t, at]
    return BoostedTrees(base, feature, cut, value, depth)


def decode(nodes: list[Node], log_odds: np.ndarray) -> list[bool]:
    """Which nodes to keep: the highest total log-odds in which nothing inside a dropped node is kept."""
    n = len(nodes)
    keep, all_drop, gain_keep = log_odds.tolist(), (-log_odds).tolist(), [0.0] * n
    for k in range(n - 1, 0, -1):
        gain_keep[k] += keep[k]
        up = nodes[k].parent
        gain_keep[up] += max(gain_keep[k], all_drop[k])
        all_drop[up] += all_drop[k]
    kept = [True] * n
    for k in range(1, n):
        kept[k] = kept[nodes[k].parent] and nodes[k].tag not in NO_TEXT and gain_keep[k] >= all_drop[k]
    return kept


def main_text(nodes: list[Node], kept: list[bool]) -> str:
    """Text of the kept nodes in page order; blocks and line breaks part words, inline elements don't."""
    out: list[str] = []
    stack: list = [(0, iter(nodes[0].children))]
    while stack:
        k, rest = stack[-1]
        for child in rest:
            if child.__class__ is str:
                if kept[k]:
                    out.append(child)
            elif kept[child]:
                if nodes[child].tag not in INLINE:
                    out.append(" ")
                stack.append((child, iter(nodes[child].children)))
                break
            elif nodes[child].tag not in INLINE:
                out.append(" ")
        else:
            stack.pop()
            if nodes[k].tag not in INLINE:
                out.append(" ")
    return _BLANK.sub(" ", "".join(out)).strip()


# Training pages. --------------------------------------------------------------------------------


def _labelled(nodes: list[Node]) -> bool:
    """Label a page by its semantic tags alone; False if it has none."""
    if not any(x.tag in _CONTENT_TAGS for x in nodes):
        return False
    for k, x in enumerate(nodes):
        up = nodes[x.parent].label if k else 0
        own = x.tag in _CONTENT_TAGS or up == 1
        x.label = int(own and x.tag not in _BOILER_TAGS and x.tag not in NO_TEXT)
    _lift(nodes)
    return True


def _lift(nodes: list[Node]) -> None:
    """Whatever holds a part of the article is on the way to it, and so is to be kept."""
    for k in range(len(nodes) - 1, 0, -1):
        if nodes[k].label:
            nodes[nodes[k].parent].label = 1


def _words(rng: random.Random, pool: list[str], least: int, most: int) -> str:
    words = rng.choice(pool).split()
    a = rng.randrange(max(1, len(words) - least))
    return html.escape(" ".join(words[a : a + rng.randint(least, most)]))


def _shorter(rng: random.Random, block: str) -> str:
    words = block.split()
    return " ".join(words[: rng.randint(3, 40)])


#: Names that page templates give to the body and to wrappers, around the name of any part.
_AROUND = ("has-{}", "with-{}", "no-{}", "{}-right", "{}-left", "{}-fixed", "{}-image", "{}-open", "page-{}", "is-{}", "{}", "hide-{}", "single {}", "{}-layout")
_PARTS = {
    "nav": ("menu", "nav", "navbar", "navigation", "main-menu"), "header": ("header", "masthead", "site-header", "topbar", "banner"),
    "notice": ("cookie-notice", "notice", "consent", "banner", "gdpr"), "ad": ("ad", "ads", "advert", "sponsored", "promo"),
    "side": ("sidebar", "related", "widget", "sidebar-right", "aside"), "form": ("search", "newsletter", "subscribe", "signup"),
    "footer": ("footer", "site-footer", "bottom footer", "colophon"), "comments": ("comments", "comment-list", "replies", "responses", "discussion"),
    "share": ("share", "social", "tags", "share-links"), "article": ("content", "main-content", "post entry", "article-body", "story", "post"),
}


def _layout(rng: random.Random, blocks: list[str], pool: list[str]) -> tuple[str, str]:
    """A page laid out anew, boilerplate marked with data-b; the marks are taken off before training."""
    w = lambda a, b: _words(rng, pool, a, b)
    # How the page names its parts: tellingly, by meaningless names, or not at all.
    naming = rng.choice(["telling"] * 5 + ["neutral"] * 2 + ["none"])
    neutral = {part: f"{rng.choice('ckxtq')}{rng.choice(['', '-', '_'])}{chr(97 + rng.randrange(26))}{rng.randrange(100)}" for part in _PARTS}
    named = lambda part: rng.choice(_PARTS[part]) if naming == "telling" else neutral[part] if naming == "neutral" else ""
    attribute = lambda name: f' {rng.choice(["class", "class", "class", "id"])}="{name}"' if name else ""
    wrap = lambda part, tags, inner: f"<{(tag := rng.choice(tags))}{attribute(named(part))} data-b>{inner}</{tag}>"
    # A name of any part around what holds the article: it says nothing.
    misnamed = lambda: " ".join(rng.choice(_AROUND).format(rng.choice(_PARTS[rng.choice(list(_PARTS))]).split()[0]) for _ in range(rng.randint(1, 3)))
    around = lambda: attribute(misnamed()) if rng.random() < 0.5 else ""
    item = lambda: f'<li><a href="/x">{w(1, 3)}</a></li>'
    menu = lambda: "<ul>" + "".join(item() for _ in range(rng.randint(3, 9))) + "</ul>"
    para = lambda a, b: f"<p>{w(a, b)}</p>"

    def comments():
        # Of one page all comments are built alike: who, when, what, links.
        who, each = rng.choice(["b", "strong", "h4", "span"]), rng.choice(["div", "li", "div", "article"])
        when, links = rng.random() < 0.5, rng.random() < 0.6
        one = lambda: (
            f"<{each}><{who}>{w(1, 2)}</{who}>" + (f"<span>{rng.randint(1, 28)}.{rng.randint(1, 12)}.2020</span>" if when else "")
            + "".join(para(4, 40) for _ in range(rng.choice([1, 1, 1, 2]))) + (f"<a href='#r'>{w(1, 1)}</a>" if links else "") + f"</{each}>"
        )
        inner = "".join(one() for _ in range(rng.randint(1, 6)))
        return f"<h3>{w(1, 2)}</h3>" + (f"<ul>{inner}</ul>" if each == "li" else inner)

    parts = {
        "nav": lambda: wrap("nav", ["nav", "div", "ul"], menu()),
        "header": lambda: wrap("header", ["header", "div"], f"<a href='/'>{w(1, 4)}</a><span>{w(2, 8)}</span>"),
        "notice": lambda: wrap("notice", ["div", "p", "section"], w(5, 30) + rng.choice([f"<a href='/p'>{w(1, 2)}</a>", f"<button>{w(1, 1)}</button>"])),
        "ad": lambda: wrap("ad", ["div", "aside", "p"], w(4, 30)),
        "side": lambda: wrap("side", ["aside", "div"], f"<h3>{w(1, 3)}</h3>" + rng.choice([menu, lambda: para(5, 40)])()),
        "form": lambda: wrap("form", ["form"], f"<label>{w(1, 4)}</label><input name=q><button>{w(1, 1)}</button>" + para(3, 20)),
        "footer": lambda: wrap("footer", ["footer", "div"], f"&copy; {w(1, 4)} &middot; {w(3, 25)}" + rng.choice(["", menu()])),
        "comments": lambda: wrap("comments", ["section", "div"], comments()),
        "share": lambda: wrap("share", ["div"], "".join(f"<a href='/s'>{w(1, 1)}</a>" for _ in range(rng.randint(2, 6)))),
    }
    make = lambda names, p: "".join(parts[x]() for x in names if rng.random() < p)
    body = []
    for k, block in enumerate(blocks):
        tag = "h1" if k == 0 and rng.random() < 0.8 else rng.choice(["p", "p", "p", "p", "h2", "blockquote"]) if len(block) < 200 else "p"
        if tag in ("h1", "h2") and rng.random() < 0.6:
            block = " ".join(block.split()[: rng.randint(1, 10)])
        if k and rng.random() < 0.06:
            body.append(f"<{(heading := rng.choice(['h2', 'h3', 'h4']))}>{w(1, 7)}</{heading}>")
        text = html.escape(block)
        if rng.random() < 0.15 and " " in text:
            a, b = text.split(" ", 1)
            text = f"<b>{a}</b> {b}" if rng.random() < 0.5 else f"<a href='/y'>{a}</a> {b}"
        body.append(f"<{tag}>{text}</{tag}>")
        if rng.random() < 0.08:
            body.append(parts[rng.choice(["ad", "share", "side", "form", "notice"])]())
    tag = rng.choice(["article", "main", "div", "div", "div", "section"])
    name = rng.choice([named("article"), named("article"), "", misnamed(), f"{named('article')} {misnamed()}"]).strip()
    article = f"<{tag}{attribute(name)}>{''.join(body)}{make(['comments', 'share'], 0.2)}</{tag}>"
    side, tail = make(rng.sample(["side", "ad"], 2), 0.45), make(rng.sample(["comments", "share", "form", "notice"], 4), 0.35)
    before, footer = make(rng.sample(["nav", "header", "notice", "ad", "form"], 5), 0.6), make(["footer"], 0.85)
    if rng.random() < 0.15:
        cells = [f"<td data-b>{make(['nav', 'side'], 0.8)}</td>", f"<td{around()}>{article}</td>", f"<td data-b>{side}</td>"]
        rng.shuffle(cells)
        middle = f"<table><tr><td colspan=3 data-b>{before}</td></tr><tr>{''.join(cells)}</tr><tr><td colspan=3 data-b>{tail}{footer}</td></tr></table>"
    else:
        middle = article + tail if rng.random() < 0.5 else rng.choice([article + side + tail, side + article + tail])
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            middle = f"<div{around()}>{middle}</div>"
        middle = f"{before}{middle}{footer}" if rng.random() < 0.7 else f"<div{around()}>{before}{middle}{footer}</div>"
    return f"<html><head><title>{w(2, 6)}</title></head><body{around()}>{middle}</body></html>", tag


def _marked(page: str) -> list[Node]:
    """Nodes of a laid-out page with labels from its marks."""
    nodes = parse(page.replace(" data-b>", " role=zzmark>"))
    inside = [False] * len(nodes)
    for k, x in enumerate(nodes):
        inside[k] = "zzmark" in x.tokens or (k > 0 and inside[x.parent])
        x.tokens = tuple(t for t in x.tokens if t != "zzmark")
        text = any(c.__class__ is str and c.strip() for c in x.children)
        x.label = int(not inside[k] and text and x.tag not in NO_TEXT)
    _lift(nodes)
    return nodes


def training_nodes(pages: list[str], layouts: int = 5, seed: int = 5) -> list[list[Node]]:
    """Labelled pages: those with semantic tags as they are, and all of them laid out anew."""
    rng = random.Random(seed)
    parsed = [parse(p) for p in pages]
    labelled = [p for p in parsed if _labelled(p)]
    texts = []
    for nodes in labelled or parsed:
        blocks = []
        for x in nodes:
            if (x.label or not labelled) and x.tag not in NO_TEXT:
                text = _BLANK.sub(" ", " ".join(c for c in x.children if c.__class__ is str)).strip()
                if text:
                    blocks.append(text)
        if blocks:
            texts.append(blocks)
    pool = [" ".join(b) for b in texts]
    out = list(labelled)
    for blocks in texts:
        for _ in range(layouts):
            # Whole articles, some of their blocks, and a few short ones: pages differ in length.
            many = rng.choice([len(blocks)] * 2 + [rng.randint(1, len(blocks)), rng.randint(1, min(8, len(blocks)))])
            a = rng.randint(0, len(blocks) - many)
            some = [blocks[0], *blocks[max(1, a) : a + many]]
            if rng.random() < 0.3:
                some = [_shorter(rng, b) for b in some]
            out.append(_marked(_layout(rng, some, pool)[0]))
    return out


def train(pages: list[str]) -> PageModel | None:
    examples = training_nodes([p for p in pages if p])
    if not examples:
        return None
    # The trees see each page with odds learned from the other half, as they will see pages not seen before.
    halves = [examples[::2], examples[1::2]]
    rows = []
    for own, other in zip(halves, halves[::-1]):
        odds = token_odds(other)
        rows += [(features(nodes, odds), np.array([x.label for x in nodes])) for nodes in own]
    x = np.concatenate([f for f, _ in rows])
    y = np.concatenate([label for _, label in rows]).astype(float)
    # Elements without any text have nothing to decide.
    some = x[:, FEATURES.index("characters")] > 0
    x, y = x[some], y[some]
    weight = np.minimum(np.log1p(x[:, FEATURES.index("characters")]), 6.0) / 3
    return PageModel(boost(x, y, weight), token_odds(examples))


def extract(page: str | None, model: PageModel) -> str:
    if not page:
        return ""
    nodes = parse(page)
    return main_text(nodes, decode(nodes, model.score([nodes])[0]))


def _extract(model: PageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                pages = [parse(p or "") for p in part.column("html").to_pylist()]
                texts = [main_text(p, decode(p, s)) for p, s in zip(pages, model.score(pages))]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return run


def fit(pages: DataFrame, rows: int = SAMPLE_PAGES) -> PageModel | None:
    """Train on at most `rows` pages, those with the smallest hashes.

    Row numbers are picked first, from hashes below a bound that leaves some three times as many, so
    tasks send a few numbers to the driver, however many tasks there are; then the pages are fetched.
    """
    span = 1 << 40
    keyed = with_row(pages.select("page_id", "html"))
    most = min(span, 3 * rows * span // max(1, pages.count()) + 1)
    hashed = keyed.select(ROW, F.pmod(F.xxhash64("page_id", ROW), F.lit(span)).alias("hash"))
    picked = hashed.filter(F.col("hash") < most).orderBy("hash", ROW).limit(rows)
    found = keyed.join(F.broadcast(picked), ROW).select("hash", ROW, "html").collect()
    return train([r["html"] for r in sorted(found, key=lambda r: (r["hash"], r[ROW]))])


def extract_pages(pages: DataFrame, model: PageModel | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    model = model or fit(pages)
    narrow = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    if model is None:  # no page with text
        found = narrow.select("page_id", "url", F.lit("").alias("text"))
    else:
        found = narrow.mapInArrow(_extract(model), "page_id bigint, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
