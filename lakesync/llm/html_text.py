"""Main text of web pages: a graphical model over the tree of a page's elements and text blocks.

Every block element and every run of text in one is a node with the two states content and
other. A node's tag, class words, text and link measures weigh for one state (log-linear); a
pair of parent and child has a potential by the kind of the child. Messages passed up and then
down the tree (sum-product, by depth, for a batch of pages at once) give each text run its
exact marginal, and runs above one half are the main text, in page order. Weights are fitted
by gradient steps on the exact likelihood of labelled pages; `labelled_pages` makes such pages
by rule, in many layouts, and `learn` takes any others of the same form.

Character references are decoded, white space inside a block becomes one space, blocks are
joined by line feeds. Rows: a null or empty page has an empty text; repeated rows are read
each; broken markup is read as far as it goes; other columns are ignored.
"""

from __future__ import annotations

import html
import pickle
import random
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.llm.common import sent

# Labelled pages that the model is fitted on, gradient steps, their rate and the decay of weights.
PAGES, STEPS, RATE, DECAY = 900, 200, 0.15, 5e-4
# Share of labelled pages of bare text.
BARE = 0.04
# Characters of pages whose nodes a task holds at a time; one longer page is held alone.
BATCH_CHARS = 1 << 21

# Element names of HTML by how they are read.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg".split())
DROPPED = frozenset("button select option datalist object canvas audio video map dialog".split())
# A start tag closes an open element of these names, up to one of the others.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
P_SCOPE = frozenset({"td", "th", "table", "button", "object", "caption"})
KINDS = {"p": 1, "h1": 2, "h2": 2, "h3": 2, "h4": 2, "h5": 2, "h6": 2, "ul": 3, "ol": 3, "li": 4, "dl": 3, "dd": 4, "dt": 4, "blockquote": 1, "pre": 1}
KIND_COUNT = 7
CONTAINERS = (0, 3, 5)

# A quote is one only where a value begins; elsewhere in a tag it is a character.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)>",
    re.S,
)
# Raw elements that hold others of their name.
NESTED = frozenset({"svg", "template"})
# Elements below this depth are put beside each other, as browsers do.
DEEPEST = 512
ATTRIBUTE = re.compile(r"(class|id|role|itemprop|itemtype|hidden|style|aria-hidden)\s*+(?:=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Page(NamedTuple):
    """Nodes in page order: parent, depth, tag, features of the markup; text of leaves, link characters, whether never shown."""

    parent: list[int]
    depth: list[int]
    kind: list[int]
    marks: list[list[str]]
    text: list[str | None]
    links: list[int]
    dropped: list[bool]


def attribute_marks(attributes: str) -> list[str]:
    out = []
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("hidden", "style", "aria-hidden"):
            if name == "hidden" or value == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                out.append("hidden")
            continue
        for word in WORD.findall(value):
            word = word.lower()
            out.append("w:" + (word[:-1] if len(word) > 3 and word[-1] == "s" and word[-2] != "s" else word))
    return out


def parsed(source: str) -> Page:
    """The tree of a page. Text outside of block elements belongs to the nearest block around it."""
    page = Page([-1], [0], [0], [["t:root"]], [None], [0], [False])
    stack: list[tuple[str, int]] = [("root", 0)]  # open elements; inline ones have their block's node
    links = 0
    run: list[str] = []
    linked = 0
    # Open elements by name, so that no tag looks for one in vain.
    opened: Counter[str] = Counter()

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            node = stack[-1][1]
            add(node, 6, ["t:text"], text, min(linked, len(text)), page.dropped[node])
        linked = 0

    def add(parent: int, kind: int, marks: list[str], text: str | None, link: int, dropped: bool) -> int:
        page.parent.append(parent)
        page.depth.append(page.depth[parent] + 1)
        page.kind.append(kind)
        page.marks.append(marks)
        page.text.append(text)
        page.links.append(link)
        page.dropped.append(dropped)
        return len(page.parent) - 1

    def close(at: int) -> None:
        nonlocal links
        if len({node for _, node in stack[at - 1 :]}) > 1:
            flush()
        for name, _ in stack[at:]:
            links -= name == "a"
            opened[name] -= 1
        del stack[at:]

    def open_element(name: str, node: int) -> None:
        stack.append((name, node))
        opened[name] += 1

    def said(text: str) -> None:
        nonlocal linked
        if text:
            run.append(text)
            if links:
                linked += len(text)

    at, size = 0, len(source)
    while at < size:
        m = TOKEN.search(source, at)
        if m is None:
            # An unfinished tag at the end is no text.
            rest = source[at:]
            said(re.sub(r"<[/!?a-zA-Z][^>]*\Z", "", rest))
            break
        said(source[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if not opened[name]:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    close(i)
                    break
                if name in INLINE and stack[i][0] not in INLINE:
                    break
            continue
        if name in RAW:
            if not (name == "svg" and m[3].endswith("/")):
                at = raw_end(source, name, at)
            continue
        if name == "br":
            run.append(" ")
            continue
        if name in INLINE and not (name == "ins" and m[3].strip()):
            open_element(name, stack[-1][1])
            links += name == "a"
            continue
        flush()
        if name in VOID:
            continue
        for i in range(len(stack) - 1, 0, -1) if opened["p"] else ():
            if stack[i][0] == "p":
                close(i)
                break
            if stack[i][0] in P_SCOPE:
                break
        names, bounds = CLOSES.get(name, ((), ()))
        if any(opened[x] for x in names):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in bounds:
                    break
                if stack[i][0] in names:
                    close(i)
                    if name not in ("tr", "tbody"):
                        break
                    continue
        if name in ("html", "body", "head"):
            continue
        parent = stack[-1][1]
        if page.depth[parent] >= DEEPEST:
            parent = page.parent[parent]
        marks = ["t:" + name, *attribute_marks(m[3])]
        open_element(name, add(parent, KINDS.get(name, 5), marks, None, 0, page.dropped[stack[-1][1]] or name in DROPPED))
    flush()
    return page


def raw_end(source: str, name: str, at: int) -> int:
    """Where an element without text of its own ends; one left open goes to the end of the page."""
    depth = 1
    for m in re.compile(rf"<(/?){name}(?![^\s/>])[^>]*>?", re.I).finditer(source, at):
        if m[1]:
            depth -= 1
        elif name in NESTED and not m[0].endswith("/>"):
            depth += 1
        if not depth:
            return m.end()
    return len(source)


def steps(value: float, *bounds: float) -> int:
    return sum(value > b for b in bounds)


def features(page: Page) -> list[list[tuple[str, float]]]:
    """Names and values of the features of each node: markup, amounts of text, links and surroundings.

    Nothing depends on how the text itself is written: odd text in an article is still its text.
    The blocks of one container are much alike, so together they weigh as much as one; else a
    long article would be judged by the sum of many small hints.
    """
    n = len(page.parent)
    chars, links, leaves, own_leaves = ([0] * n for _ in range(4))
    around = [0] * n
    for i in range(1, n):
        up = page.parent[i]
        around[i] = up if page.kind[up] in CONTAINERS else around[up]
        own_leaves[around[i]] += page.text[i] is not None
    for i in range(n - 1, -1, -1):
        text = page.text[i]
        if text is not None:
            chars[i], links[i], leaves[i] = len(text), page.links[i], 1
        up = page.parent[i]
        if up >= 0:
            chars[up] += chars[i]
            links[up] += links[i]
            leaves[up] += leaves[i]
    total = max(1, chars[0])
    out = []
    for i in range(n):
        kind = page.kind[i]
        density = steps(links[i] / max(1, chars[i]), 0.1, 0.3, 0.6, 0.9)
        share = 1.0 if kind in CONTAINERS else 1 / max(1, own_leaves[around[i]])
        # Amounts count by kind of node; the part of the page's text tells wrappers from their contents.
        names = [
            f"c{kind}:{steps(chars[i], 0, 20, 60, 150, 400, 1500)}",
            f"l{kind}:{density}",
            f"h{kind}:{steps(chars[i] / total, 0.02, 0.1, 0.3, 0.6, 0.9, 0.98)}",
            f"b{kind}:{steps(leaves[i], 1, 3, 8, 20)}",
        ]
        if kind == 6:
            names += ["p" + page.marks[page.parent[i]][0], f"e:{steps(chars[i], 60)}{density > 1}"]
        # Words of class names keep their weight.
        out.append([(x, share) for x in names] + [(x, 1.0 if x[0] == "w" else share) for x in page.marks[i]])
    return out


class Model(NamedTuple):
    """Numbers of the features, their weights towards content, log potentials [kind of child, parent state, child state]."""

    numbers: dict[str, int]
    weights: np.ndarray
    pairs: np.ndarray


class Forest:
    """Trees of many pages, laid out by depth for the passing of messages."""

    def __init__(self, pages: list[Page], numbers: dict[str, int], grow: bool = False):
        parents, kinds, depths, node, feature, value = [], [], [], [], [], []
        base = 0
        self.starts = []
        for page in pages:
            self.starts.append(base)
            parents.append(np.array(page.parent) + base)
            kinds.append(page.kind)
            depths.append(page.depth)
            for i, names in enumerate(features(page)):
                for name, share in names:
                    number = numbers.setdefault(name, len(numbers)) if grow else numbers.get(name)
                    if number is not None:
                        node.append(base + i)
                        feature.append(number)
                        value.append(share)
            base += len(page.parent)
        self.size = base
        self.parent = np.concatenate(parents) if parents else np.zeros(0, np.int64)
        self.kind = np.concatenate(kinds).astype(np.int64) if kinds else np.zeros(0, np.int64)
        depth = np.concatenate(depths).astype(np.int64) if depths else np.zeros(0, np.int64)
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []
        self.node, self.feature, self.value = np.array(node, np.int64), np.array(feature, np.int64), np.array(value, np.float64)

    def odds(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.node, weights[self.feature] * self.value, self.size)

    def marginals(self, model_weights: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(content) of each node and P(parent state, own state) of each node with a parent, by one pass up and one down."""
        below = np.zeros((self.size, 2))
        below[:, 1] = self.odds(model_weights)
        upward = np.zeros((self.size, 2))
        for level in reversed(self.levels[1:]):
            # Of a child to its parent: the sum over its own states.
            sent = np.logaddexp.reduce(below[level][:, None, :] + pairs[self.kind[level]], axis=2)
            sent -= sent.max(axis=1, keepdims=True)
            upward[level] = sent
            for state in (0, 1):
                np.add.at(below[:, state], self.parent[level], sent[:, state])
        above = np.zeros((self.size, 2))
        edges = np.zeros((self.size, 2, 2))
        for level in self.levels[1:]:
            up = self.parent[level]
            # What the parent believes without this child.
            rest = above[up] + below[up] - upward[level]
            joint = rest[:, :, None] + pairs[self.kind[level]]
            message = np.logaddexp.reduce(joint, axis=1)
            above[level] = message - message.max(axis=1, keepdims=True)
            joint = joint + below[level][:, None, :]
            joint -= joint.max(axis=(1, 2), keepdims=True)
            joint = np.exp(joint)
            edges[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
        belief = above + below
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50))), edges


def learn(labelled: list[tuple[str, str]]) -> Model:
    """Fit on (html, main text) of pages, the text in the form that this operator returns."""
    pages = [parsed(source) for source, _ in labelled]
    numbers: dict[str, int] = {}
    forest = Forest(pages, numbers, grow=True)
    state = np.concatenate([states(page, text) for page, (_, text) in zip(pages, labelled, strict=True)])
    weights, pairs = np.zeros(len(numbers)), np.zeros((KIND_COUNT, 2, 2))
    inner = np.concatenate(forest.levels[1:])
    seen = np.zeros_like(pairs)
    np.add.at(seen, (forest.kind[inner], state[forest.parent[inner]], state[inner]), 1.0)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(pairs), np.zeros_like(pairs)]
    for step in range(1, STEPS + 1):
        content, edges = forest.marginals(weights, pairs)
        expected = np.zeros_like(pairs)
        np.add.at(expected, forest.kind[inner], edges[inner])
        slopes = (
            np.bincount(forest.feature, (state - content)[forest.node] * forest.value, len(weights)) / len(pages) - DECAY * weights,
            (seen - expected) / len(pages) - DECAY * pairs,
        )
        for k, slope in enumerate(slopes):
            one = moments[2 * k] = 0.9 * moments[2 * k] + 0.1 * slope
            two = moments[2 * k + 1] = 0.99 * moments[2 * k + 1] + 0.01 * slope * slope
            change = RATE * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-8)
            if k:
                pairs = pairs + change
            else:
                weights = weights + change
    return Model(numbers, weights, pairs)


def states(page: Page, text: str) -> np.ndarray:
    """1 for the runs of the main text and for elements with nothing but main text, or mostly under one with content."""
    wanted = text.split("\n")
    n = len(page.parent)
    out = np.zeros(n, np.int64)
    at = 0
    inside, all_chars = np.zeros(n), np.zeros(n)
    for i in range(n):
        if page.text[i] is not None:
            all_chars[i] = len(page.text[i])
            if at < len(wanted) and page.text[i] == wanted[at]:
                out[i], inside[i] = 1, all_chars[i]
                at += 1
    for i in range(n - 1, 0, -1):
        inside[page.parent[i]] += inside[i]
        all_chars[page.parent[i]] += all_chars[i]
    total = inside[0]
    for i in range(1, n):
        if page.text[i] is None and all_chars[i]:
            # Within the article an element is content; around it, the smallest that holds all of it.
            up = page.parent[i]
            holds_all = total and inside[i] == total and not any(page.parent[j] == i and inside[j] == total for j in range(i + 1, n))
            out[i] = int(inside[i] > 0 and (holds_all or out[up] == 1 or inside[i] == all_chars[i]))
    return out


# Words of class names in use for parts of pages.
PARTS = {
    "menu": "nav navbar navigation menu topnav breadcrumb breadcrumbs links toc pagination pager tabs",
    "header": "header masthead banner top logo branding site-header page-header toolbar",
    "footer": "footer bottom copyright colophon legal site-footer page-footer credits imprint",
    "side": "sidebar side aside widget rail secondary right-column left-column related recommended trending popular more-stories tags tagcloud",
    "notice": "notice cookie cookies consent gdpr alert message popup modal overlay disclaimer paywall announcement privacy banner-notice warning info-box",
    "advert": "ad ad ads advert advertisement adsense sponsored sponsor promo promotion banner-ad dfp commercial teaser",
    "form": "form search login signup subscribe newsletter contact subscription register search-form mailing",
    "comments": "comments comment comment-list replies reply respond discussion disqus responses feedback user-comments reviews thread",
    "share": "share social sharing follow share-buttons social-links author-bio byline-links tools print",
}
ARTICLE = "content article post entry story main body text main-content post-content entry-content article-body story-body page-content articleBody post-body prose markdown"


def labelled_pages(count: int = PAGES, seed: int = 1) -> list[tuple[str, str]]:
    """(html, main text) of pages made by rule: layouts with and without meaningful tags, parts around and inside the article."""
    pick = random.Random(seed)
    style = 0

    def sentence(low: int = 3, high: int = 18) -> str:
        words = ["".join(pick.choice("abcdefghiklmnoprstuvwz") for _ in range(pick.randint(2, 9))) for _ in range(pick.randint(low, high))]
        if style == 1:  # marks after every word
            return " ".join(w + pick.choice(["***", "$$$", "%%%", "###", "!!"]) for w in words)
        if style == 2:  # cells of a list
            return " | ".join(words)
        if style == 3:  # the same word again and again
            return " ".join(words[:1] * pick.randint(5, 40))
        if style == 4:  # no marks at all
            return " ".join(words)
        return " ".join(words).capitalize() + pick.choice("...?!")

    def prose(low: int, high: int) -> str:
        return " ".join(sentence() for _ in range(pick.randint(low, high)))

    def short() -> str:
        return sentence(1, 4)[:-1]

    def inline(text: str) -> str:
        words = text.split(" ")
        if len(words) > 3 and pick.random() < 0.4:
            i = pick.randrange(len(words))
            tag = pick.choice(["b", "em", "strong", "i", "span", 'a href="/x"', "code"])
            words[i] = f"<{tag}>{words[i]}</{tag.split()[0]}>"
        return " ".join(words)

    def links(n: int) -> str:
        items = [f'<a href="/{i}">{short()}</a>' for i in range(n)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if pick.random() < 0.7 else " | ".join(items)

    def named(part: str, tags: list[str], inner: str) -> str:
        tag = pick.choice(tags)
        name = pick.choice(PARTS[part].split())
        bare = tag not in ("div", "section", "ul", "p") and pick.random() < 0.6
        key = pick.choice(["class", "class", "id"])
        extra = pick.choice(["", " box", " block", " clearfix", " wrap", " col-3"]) if key == "class" else ""
        return f"<{tag}>{inner}</{tag}>" if bare else f'<{tag} {key}="{name}{extra}">{inner}</{tag}>'

    def part(kind: str) -> str:
        if kind == "menu":
            return named(kind, ["nav", "nav", "div", "ul"], links(pick.randint(3, 9)))
        if kind == "header":
            return named(kind, ["header", "div"], f'<a href="/">{short()}</a>' + pick.choice(["", f"<p>{sentence(3, 8)}</p>", f"<h2>{short()}</h2>"]))
        if kind == "footer":
            return named(kind, ["footer", "footer", "div"], f"&copy; {short()} &middot; " + pick.choice([sentence(), f"<p>{sentence()}</p>", links(4), prose(1, 4), prose(1, 4)]))
        if kind == "side":
            return named(kind, ["aside", "div", "section"], f"<h3>{short()}</h3>" + pick.choice([links(5), f"<p>{prose(1, 3)}</p>", f"<ul><li>{sentence()}</li><li>{sentence()}</li></ul>"]))
        if kind == "notice":
            return named(kind, ["div", "section", "p", "div"], pick.choice([prose(1, 3), f"<p>{prose(1, 3)}</p>", f"{sentence()} <button>OK</button>"]))
        if kind == "advert":
            return named(kind, ["div", "div", "ins", "section"], pick.choice([prose(1, 5), prose(1, 5), f"<p>{prose(1, 4)}</p>", f'<a href="/ad">{sentence()}</a>']))
        if kind == "form":
            inner = f'<label>{short()}</label><input name="q"><p>{sentence()}</p><button>{short()}</button>'
            return pick.choice([f"<form>{inner}</form>", named(kind, ["form", "div"], f"<form>{inner}</form>"), named(kind, ["div"], f"<p>{sentence()}</p>{inner}")])
        if kind == "comments":
            each = [named(kind, ["div", "li", "article"], f"<b>{short()}</b><p>{prose(1, 4)}</p>") for _ in range(pick.randint(1, 5))]
            return named(kind, ["section", "div", "div"], f"<h3>{short()}</h3>" + "".join(each))
        return named(kind, ["div", "div", "ul"], pick.choice([links(4), f'<a href="#">{short()}</a> <a href="#">{short()}</a>', sentence(2, 5)]))

    def article() -> tuple[str, list[str]]:
        out, texts = [], []
        if pick.random() < 0.85:
            title = sentence(2, 10)[: pick.choice([60, 200])]
            out.append(f"<h1>{title}</h1>")
            texts.append(title)
        for _ in range(pick.choice([1, 2, 3, 4, 6, 9, 14, 40])):
            kind = pick.random()
            if kind < 0.72:
                text = prose(1, 7) if pick.random() < 0.85 else sentence(1, 4)
                opened = pick.choice(["<p>{}</p>"] * 6 + ["<p>{}", "<div>{}</div>", "<p><b>{}<br>", "<blockquote>{}</blockquote>"])
                out.append(opened.format(inline(text)))
                texts.append(text)
            elif kind < 0.85:
                text = sentence(1, 7)[:-1]
                tag = pick.choice(["h2", "h3"])
                out.append(f"<{tag}>{text}</{tag}>")
                texts.append(text)
            elif kind < 0.95:
                items = [sentence(2, 12) for _ in range(pick.randint(2, 5))]
                tag = pick.choice(["ul", "ol"])
                out.append(f"<{tag}>" + "".join(f"<li>{inline(x)}</li>" for x in items) + f"</{tag}>")
                texts += items
            else:
                cells = [short() for _ in range(4)]
                out.append(f"<table><tr><td>{cells[0]}</td><td>{cells[1]}</td></tr><tr><td>{cells[2]}</td><td>{cells[3]}</td></tr></table>")
                texts += cells
        for _ in range(pick.choice([0, 0, 1, 2])):
            out.insert(pick.randint(min(1, len(out)), len(out)), part(pick.choice(["advert", "advert", "share", "side", "form", "notice", "menu"])))
        return "".join(out), texts

    pages = []
    for _ in range(count):
        # One page in three has odd text, which only its place in the tree can tell.
        style = pick.choice([0] * 8 + [1, 2, 3, 4])
        inner, texts = article()
        style = pick.choice([0] * 8 + [1, 2, 3, 4])
        name = pick.choice(ARTICLE.split())
        key = pick.choice(["class", "id"])
        body = pick.choice(
            [f"<article>{inner}</article>"] * 4
            + [f"<main>{inner}</main>", f"<main><article>{inner}</article></main>", f'<article {key}="{name}">{inner}</article>']
            + [f'<div {key}="{name}">{inner}</div>'] * 4
            + [f'<div class="row"><div class="col-8"><div {key}="{name}">{inner}</div></div></div>', f"<section><div>{inner}</div></section>", f'<section class="{name}">{inner}</section>']
        )
        before = [part(k) for k in ("menu", "header", "notice", "advert", "side", "form", "share") if pick.random() < 0.4]
        after = [part(k) for k in ("comments", "side", "advert", "share", "form", "menu", "notice", "footer") if pick.random() < 0.4]
        pick.shuffle(before)
        if pick.random() < 0.7:
            after.append(part("footer"))
        whole = "".join(before) + body + "".join(after)
        if pick.random() < 0.3:
            whole = f'<div {pick.choice(["class", "id"])}="{pick.choice(["wrapper", "container", "page", "site", "layout"])}">{whole}</div>'
        if pick.random() < 0.05:
            whole = f"<form>{whole}</form>"
        pages.append((f"<html><head><title>{short()}</title></head><body>{whole}</body></html>", "\n".join(texts)))
    style = 0
    for _ in range(int(BARE * count)):
        # Nothing but text: no part, no container, often a single block.
        texts = [prose(1, 5) for _ in range(pick.choice([1, 1, 1, 2, 3]))]
        body = pick.choice(["", "", "<div>"]) + "".join(f"<p>{inline(x)}</p>" for x in texts)
        pages.append((f"<html><body>{body}</body></html>", "\n".join(texts)))
    return pages


def main_blocks(sources: list[str], model: Model) -> list[list[str]]:
    """The blocks of main text of each page."""
    pages = [parsed(x) for x in sources]
    forest = Forest(pages, model.numbers)
    content, _ = forest.marginals(model.weights, model.pairs)
    out = []
    for page, start in zip(pages, forest.starts, strict=True):
        shown = content[start : start + len(page.parent)] > 0.5
        out.append([t for t, keep, dropped in zip(page.text, shown.tolist(), page.dropped, strict=True) if t is not None and keep and not dropped])
    return out


def fitted(spark: SparkSession) -> Model:
    """The model of the pages made by rule, fitted in a task."""

    def train(batches):
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(learn(labelled_pages()))], pa.binary())], names=["model"])

    row = spark.range(1, numPartitions=1).mapInArrow(train, "model binary").first()
    return pickle.loads(row.model)


def extracted(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text, n_chars and n_blocks of every page."""
    shared = sent(pages.sparkSession, model or fitted(pages.sparkSession))
    id_type = dict(pages.dtypes)["page_id"]

    def run(batches):
        known = shared.value
        for batch in batches:
            sources = batch.column("html").to_pylist()
            texts, counts = [], []
            low = 0
            while low < len(sources):
                high, size = low, 0
                while high < len(sources) and (high == low or size + len(sources[high] or "") <= BATCH_CHARS):
                    size += len(sources[high] or "")
                    high += 1
                for blocks in main_blocks([x or "" for x in sources[low:high]], known):
                    texts.append("\n".join(blocks))
                    counts.append(len(blocks))
                low = high
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64()), pa.array(counts, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_blocks"],
            )

    wanted = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return wanted.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long, n_blocks long")
