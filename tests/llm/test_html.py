"""Main text: sums and thresholds against their definition, broken mark-up, layout classes, several articles, hostile pages."""

from __future__ import annotations

import math
import random
import time

import pytest

from txrisk.llm import op01_html
from txrisk.llm.op01_html import main_text

LONG = ("A long sentence of running words that goes on, and on. " * 4).strip()


def random_page(rng: random.Random, depth: int = 0) -> str:
    parts = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if depth < 5 and kind < 0.5:
            tag = rng.choice(["div", "section", "p", "blockquote"] if depth < 4 else ["p"])
            inner = "word " * rng.randint(0, 30) if tag == "p" else random_page(rng, depth + 1)
            parts.append(f"<{tag}>{inner}</{tag}>")
        elif kind < 0.65:
            parts.append(f"<a href=x>{'link ' * rng.randint(1, 6)}</a>")
        elif kind < 0.8:
            parts.append(f"<b>bold <i>{'text ' * rng.randint(0, 9)}</i></b>")
        else:
            parts.append("plain " * rng.randint(0, 12))
    return "".join(parts)


def texts(node, link=False):
    """(characters, whether in a link) of every piece of text below a node."""
    for c in node.children:
        if isinstance(c, str):
            yield len(c.strip()), link or node.tag == "a"
        else:
            yield from texts(c, link or node.tag == "a")


def below(node):
    for c in node.children:
        if not isinstance(c, str):
            yield c
            yield from below(c)


def own(node, link=False):
    """As ``texts``, of a block without the blocks in it."""
    for c in node.children:
        if isinstance(c, str):
            yield len(c.strip()), link
        elif c.tag not in op01_html._BLOCKS:
            yield from own(c, link or c.tag == "a")


def density(chars, tags, link_chars, link_tags, share):
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + share * chars + math.e)
    return chars / max(tags, 1) * max(math.log(max(chars, 1) / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1)) / base, 0)


def by_definition(node, share):
    found = list(texts(node))
    tags = [n for n in below(node) if n.tag == "a" or n.tag in op01_html._BLOCKS]
    return density(sum(n for n, _ in found), len(tags), sum(n for n, link in found if link), sum(n.tag == "a" for n in tags), share)


def sum_by_definition(node, share):
    pieces = list(own(node))
    linked = sum(n for n, link in pieces if link)
    total = density(sum(n for n, _ in pieces), 1, linked, int(linked > 0), share)
    children, rest = [], list(node.children)
    while rest:
        c = rest.pop()
        if not isinstance(c, str):
            if c.tag in op01_html._BLOCKS:
                children.append(c)
            else:
                rest += c.children
    return total + sum(by_definition(c, share) for c in children)


@pytest.mark.parametrize("seed", range(60))
def test_core_and_threshold_by_definition(seed):
    root = op01_html._parse(f"<body>{random_page(random.Random(seed))}</body>")
    op01_html._measure(root)
    best, threshold = op01_html._core(root)
    body = next(c for c in root.children if not isinstance(c, str) and c.tag == "body")
    found = list(texts(body))
    share = sum(n for n, link in found if link) / max(sum(n for n, _ in found), 1)
    nodes = [root] + [n for n in below(root) if n.tag in op01_html._BLOCKS]
    for n in nodes:
        assert n.density == pytest.approx(by_definition(n, share), abs=1e-9)
        assert n.total == pytest.approx(sum_by_definition(n, share), abs=1e-9)
    assert best.total == pytest.approx(max(sum_by_definition(n, share) for n in nodes))
    path, up = [], best
    while up is not None:
        path.append(by_definition(up, share))
        up = up.parent
    assert threshold == pytest.approx(min(path))


def test_no_node_is_selected_by_its_name():
    # The greatest sum is outside the element that calls itself an article.
    out = main_text(f"<body><article><a href=x>one</a> <a href=y>two</a></article><div><p>{LONG}</p><p>{LONG}</p></div></body>")
    assert out == f"{LONG}\n{LONG}"


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="layout has-sidebar"><article><p>{LONG}</p></article></div>',
        f'<div id="page" class="no-sidebar nav-open"><p>{LONG}</p></div>',
        f'<div class="sidebar"><article><p>{LONG}</p></article></div>',
        f'<div class="widget"><p>{LONG}</p></div>',
        f"<p title=don't>{LONG}</p>",
        f'<p title="open>{LONG}</p>',
        f"</div></p></article><div><p>{LONG}</div></section>",
        f"<article><div class=ad><p>buy</article><article><p>{LONG}",
        f"<p>{LONG}</p><div",
    ],
)
def test_broken_markup_and_layout_classes(page):
    assert main_text(page) == LONG


def test_several_articles_and_short_paragraphs():
    page = f"<article><h1>A</h1><p>{LONG}</p><p>so</p></article><article><h2>B</h2><p>yes</p><p>{LONG}</p></article>"
    assert main_text(page) == f"A\n{LONG}\nso\nB\nyes\n{LONG}"
    nested = f"<article><section><p>{LONG}</p><p>{LONG}</p></section><section><p>no</p></section></article>"
    assert main_text(nested) == f"{LONG}\n{LONG}\nno"


def test_what_is_left_out():
    comments = f'<section class="comments"><article class="comment"><p>{LONG}{LONG}</p></article></section>'
    page = f"<article><header><h1>T</h1><p>By me</p></header><p>{LONG}</p><footer>F</footer>{comments}</article>"
    page += f'<div class="site-footer">{LONG}</div><div id="cookie-banner">{LONG}{LONG}</div><div hidden>{LONG}</div>'
    assert main_text(page) == f"T\n{LONG}"


@pytest.mark.parametrize("unit", ["<div>", "</div>", "<ul><li>", "<article>", '<p title="', "<b><p>", "<nav>", "<h1><b>"])
def test_hostile_pages_take_linear_time(unit):
    def seconds(n: int) -> float:
        start = time.process_time()
        main_text("word " + unit * n)
        return time.process_time() - start

    assert seconds(40_000) < 8 * max(seconds(10_000), 0.1)


def test_deep_text_stays():
    assert main_text("<div>" * 5_000 + "deep" + "</div>" * 5_000 + " after") == "deep\nafter"
