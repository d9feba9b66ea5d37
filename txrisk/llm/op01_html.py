"""Main text of web pages by composite text density.

The nodes are the block elements; inline mark-up is text of its block, and text directly in a block counts as a block of its own. Every
node gets a density: characters per tag, lowered by the share of its text that stands in links. A node's sum is the total density of
its children. The subtree with the greatest sum is the core of the page; the smallest density on the path from ``body`` to it is the
threshold which decides what else belongs to the text. Mark-up never selects the core. It says what is left out, and an ``article``
that reaches the threshold in a block is kept with its short paragraphs too.

Class words count as the role of an element (``site-footer``, ``comments-list``), not where they describe its layout
(``has-sidebar``), and an element that holds the article is not left out for them.

Pages are independent, so the work is one narrow pass: no shuffle, one page in memory at a time, linear in its length. Elements
nested more than 512 deep become siblings, as in browsers; their text stays.

Defined cases: null or empty html gives an empty text; a page without mark-up is one block; html cut off inside a tag loses that
tag; a quote that never ends is an ordinary character; end tags without a start are ignored; of a header inside an article only
headings count; repeated rows give repeated results; very long pages are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# A comment, a declaration, or a tag with its attributes; a tag that never ends takes the rest of the page.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:[!?]|/[^a-zA-Z>])[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
_RAW = {t: re.compile(rf"</{t}\b[^>]*>?", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An opening tag of the key ends an open element of the value, unless one of _SCOPES stands between.
_ENDS = {t: frozenset(e.split()) for t, e in {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th"}.items()}
_SCOPES = frozenset("ul ol dl table select article section div body html".split())
_PARAGRAPH = frozenset({"p"})
_CLOSED_BY_HEADINGS = _PARAGRAPH | _HEADINGS
_PARAGRAPH_SCOPES = _SCOPES | {"li", "td", "th"}
# Elements and words of class, id or role that never hold article text.
_NO_TEXT = frozenset(
    "head script style noscript template iframe object svg canvas audio video math nav footer aside form button select textarea "
    "input label dialog menu title xmp".split()
)
_NO_TEXT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar footer comment comments disqus respond cookie cookies consent gdpr notice notices popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations widget "
    "widgets toolbar masthead pagination pager search copyright contentinfo complementary alert".split()
)
_HEADER_WORDS = frozenset("header topbar".split())
# Words that may name the frame of a whole page, and those that may hold articles of others.
_FRAME_WORDS = _HEADER_WORDS | frozenset("nav navbar navigation menu sidebar footer widget widgets toolbar masthead".split())
_OTHERS_WORDS = frozenset("comment comments disqus related recommended recommendations".split())
# With one of these, a class describes a state or the layout of its element.
_STATES = frozenset("has no not with without is open opened closed active inactive enabled disabled visible expanded collapsed layout".split())
_WORDS = re.compile(r"[a-z0-9]+")
_DEPTH = 512


class _Node:
    __slots__ = ("tag", "parent", "children", "depth", "drop", "by_class", "holds", "words", "chars", "own", "tags", "link_chars", "link_tags", "own_links", "density", "total")

    def __init__(self, tag: str, parent: _Node | None, words: frozenset[str] = frozenset()):
        self.tag, self.parent, self.words = tag, parent, words
        self.depth = parent.depth + 1 if parent else 0
        self.drop = self.by_class = self.holds = False
        self.children: list[_Node | str] = []


def _parse(page: str) -> _Node:
    """The tree of a page, without the elements that never hold article text."""
    root = _Node("html", None)
    node, at, opened = root, 0, Counter()  # opened: how often each name is open
    frames: list[_Node] = []  # elements left out for their class words

    def leave(up: _Node | None) -> None:
        nonlocal node
        while node is not up and node.parent is not None:
            opened[node.tag] -= 1
            node = node.parent

    def close(tags: frozenset[str], until: frozenset[str]) -> None:
        if any(opened[t] > 0 for t in tags):
            up = node
            while up.parent is not None and up.tag not in until | tags:
                up = up.parent
            if up.tag in tags:
                leave(up.parent)

    while m := _MARKUP.search(page, at):
        if m.start() > at:
            node.children.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag] > 0 and tag not in ("html", "body"):
                up = node
                while up.tag != tag:
                    up = up.parent
                leave(up.parent)
            continue
        if tag in ("html", "body"):
            if tag == "body" and not opened["body"]:
                leave(root)
                node = _child(root, "body")
                opened["body"] += 1
            continue
        if tag in _RAW:
            at = end.end() if (end := _RAW[tag].search(page, at)) else len(page)
            continue
        if tag in _BLOCKS and tag != "hr":
            close(_CLOSED_BY_HEADINGS if tag in _HEADINGS else _PARAGRAPH, _PARAGRAPH_SCOPES)
        if tag in _ENDS:
            close(_ENDS[tag], _SCOPES)
        if tag in _VOID:
            if tag in ("br", "hr", "img", "wbr"):
                _child(node, tag)
            continue
        words = _described(m[3]) if m[3] else frozenset()
        inside = opened["article"] > 0 or opened["main"] > 0
        if node.depth >= _DEPTH:
            leave(node.parent)
        child = _child(node, tag, words)
        child.drop = tag in _NO_TEXT or "hidden" in words or tag == "header" and not inside
        named = words & _OTHERS_WORDS if tag in ("article", "main") else words & _NO_TEXT_WORDS or not inside and words & _HEADER_WORDS
        if not child.drop and named:
            child.drop = child.by_class = True
            frames.append(child)
        if tag in ("article", "main") and not child.drop:
            up = child
            while up is not None and not up.holds and not (up.drop and not up.by_class) and not up.words & _OTHERS_WORDS:
                up.holds, up = True, up.parent
        if not (child.drop and m[0].endswith("/>")):
            opened[tag] += 1
            node = child
    if at < len(page):
        node.children.append(page[at:])
    _keep_frames(root, frames)
    _prune(root)
    return root


def _child(node: _Node, tag: str, words: frozenset[str] = frozenset()) -> _Node:
    child = _Node(tag, node, words)
    node.children.append(child)
    return child


def _above(node: _Node | None) -> Iterator[_Node]:
    while node is not None:
        yield node
        node = node.parent


def _elements(node: _Node) -> list[_Node]:
    return [c for c in node.children if c.__class__ is _Node]


def _down(root: _Node) -> list[_Node]:
    """All nodes, parents before children, in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        if node.children:
            stack += [c for c in reversed(node.children) if c.__class__ is _Node]
    return order


def _keep_frames(root: _Node, frames: list[_Node]) -> None:
    """Elements left out for a class word stay where they hold the article: by its element, or by most of the plain text."""
    for node in frames:
        node.drop = not node.holds
    layout = [n for n in frames if n.drop and n.words & _NO_TEXT_WORDS <= _FRAME_WORDS]
    if root.holds or not layout:
        return
    plain: dict[int, int] = {}
    for node in reversed(_down(root)):
        text = sum(len(c.strip()) if c.__class__ is str else plain[id(c)] for c in node.children)
        plain[id(node)] = 0 if node.drop and not node.by_class or node.tag == "a" else text
    for node in layout:
        node.drop = 2 * plain[id(node)] <= plain[id(root)]


def _prune(root: _Node) -> None:
    """Takes out what is left out; of a header inside an article headings stay."""
    stack = [root]
    while stack:
        node = stack.pop()
        if node.tag == "header" and not node.drop:
            headings = [n for n in _down(node) if n.tag in _HEADINGS and not any(up.drop for up in _between(n, node))]
            node.children = list(headings)
            for n in headings:
                n.parent = node
        node.children = [c for c in node.children if isinstance(c, str) or not c.drop]
        stack.extend(_elements(node))


def _between(node: _Node, top: _Node) -> Iterator[_Node]:
    for up in _above(node):
        if up is top:
            return
        yield up


def _described(attributes: str) -> frozenset[str]:
    """The words that class, id and role name an element by, and ``hidden`` where it isn't shown."""
    words: set[str] = set()
    for a in _ATTRIBUTE.finditer(attributes):
        name, value = a[1].lower(), (a[2] or a[3] or a[4] or "").lower()
        if name in ("class", "id", "role", "itemprop"):
            for token in value.split():
                parts = _WORDS.findall(token)
                if parts and not _STATES.intersection(parts):
                    words |= {parts[0], parts[-1]}
            words.discard("hidden")
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
            return frozenset({"hidden"})
    return frozenset(words)


def _density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters per tag, lowered by links; ``share`` is that of link text in the body."""
    plain = max(chars - link_chars, 1)
    base = math.log(chars / plain * link_chars + share * chars + math.e)
    lift = math.log(max(chars, 1) / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1)) / base
    return chars / max(tags, 1) * max(lift, 0.0)


def _measure(root: _Node) -> None:
    """Density and sum of every node, children first. Text is counted without white space at its ends."""
    order = _down(root)
    for node in reversed(order):
        # Own text includes that of inline elements; these are no tags, except for links.
        chars = own = tags = link_chars = link_tags = own_links = 0
        for c in node.children:
            if c.__class__ is str:
                n = len(c.strip())
                chars += n
                own += n
                continue
            chars += c.chars
            tags += c.tags
            link_chars += c.link_chars
            link_tags += c.link_tags
            if c.tag in _BLOCKS:
                tags += 1
            else:
                own += c.own
                own_links += c.own_links
                if c.tag == "a":
                    tags += 1
                    link_tags += 1
        if node.tag == "a":
            link_chars, own_links, link_tags = chars, own, tags
        node.chars, node.own, node.tags, node.link_chars, node.link_tags, node.own_links = chars, own, tags, link_chars, link_tags, own_links
    body = max((c for c in _elements(root) if c.tag == "body"), key=lambda c: c.chars, default=root)
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in reversed(order):
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, share) if node.chars else 0.0
        # The sum of an inline element is that of the blocks in it; its own text counts with the block around.
        node.total = 0.0
        for c in node.children:
            if c.__class__ is _Node:
                node.total += c.density if c.tag in _BLOCKS else c.total
        if node.own and node.tag in _BLOCKS:
            node.total += _density(node.own, 1, node.own_links, int(node.own_links > 0), share)


def _core(root: _Node) -> tuple[_Node, float]:
    """The node with the greatest sum (ties: the one with most text, then the first), and the smallest density on the path to it."""
    best = root
    for node in _down(root):
        if node.tag in _BLOCKS and (node.total, node.chars) > (best.total, best.chars):
            best = node
    return best, min(n.density for n in _above(best))


def _selected(root: _Node) -> list[_Node]:
    """The nodes whose text is the article, in page order."""
    best, threshold = _core(root)
    path = {id(n) for n in _above(best)}
    # The core's article is whole, wherever in it the core stands.
    top = next((n for n in reversed(list(_above(best))) if n.tag == "article"), best)
    reaches: dict[int, bool] = {}
    for node in reversed(_down(root)):
        reaches[id(node)] = node.tag in _BLOCKS and node.chars > 0 and node.density >= threshold or any(reaches[id(c)] for c in _elements(node))
    chosen: list[_Node] = []
    stack, before = [root], True
    while stack:
        node = stack.pop()
        if node is top:
            chosen.append(node)
            before = False
        elif id(node) in path or not reaches[id(node)]:
            if id(node) in path or node.tag in ("div", "section", "hgroup", "main"):
                stack.extend(reversed(list(_elements(node))))
            elif before and node.tag in _HEADINGS and 2 * node.link_chars <= node.chars:
                chosen.append(node)
        elif node.density >= threshold and node.tag in _BLOCKS or node.tag == "article" and 2 * node.link_chars <= node.chars:
            chosen.append(node)
        else:
            stack.extend(reversed(list(_elements(node))))
    return chosen


def _blocks(nodes: list[_Node]) -> Iterator[str]:
    """The text of each block in page order, white space not yet made one."""
    parts: list[str] = []
    for top in nodes:
        stack: list[tuple[_Node | str, bool]] = [(top, False)]
        while stack:
            item, ended = stack.pop()
            if isinstance(item, str):
                parts.append(item)
            elif item.tag in _BLOCKS or item is top:
                yield "".join(parts)
                parts = []
                if not ended:
                    stack.append((item, True))
                    stack.extend((c, False) for c in reversed(item.children))
            elif item.tag == "br":
                parts.append(" ")
            else:
                stack.extend((c, False) for c in reversed(item.children))
    yield "".join(parts)


def main_text(page: str | None) -> str:
    """The article of one page; blocks are joined by a line feed."""
    if not page:
        return ""
    root = _parse(page)
    _measure(root)
    texts = (" ".join(html.unescape(b).split()) for b in _blocks(_selected(root)))
    return "\n".join(t for t in texts if t)


def extract_main_text(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, then ``text`` and ``n_chars`` (code points) of every page."""
    frame = pages.select(*keep, html_column)
    schema = frame.drop(html_column).schema.add("text", "string").add("n_chars", "long")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text", "n_chars"])

    return frame.mapInArrow(extract, schema)
