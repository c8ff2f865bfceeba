"""Main text of web pages: flat text blocks, classified by a decision tree over words, link density and neighbours.

A page becomes a flat list of text blocks. Each has its own and its neighbours' words and link density, whether it is a
heading or a list item, how the elements around it are marked (as article, or by name, class or role as something else),
and which share of the page's plain words the marked element holds: a box with most of the text isn't an advert, whatever
its name. A decision tree grown from a small table of blocks labelled by hand says which blocks are main text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import only, strings

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "heading", "item", "mark", "share")

# Pages labelled by hand, one a line. Text stands as numbers of words: +7 is a block of seven words of main text, -7 seven
# words of something else. What stands in <a> is linked.
LABELLED = """
<nav><ul><li><a>-1</a><li><a>-2</a><li><a>-1</a><li><a>-3</a></ul></nav><div class=ad>-8</div><article><h1>+8</h1><p>+3<p>+45<p>+60<p>+1<p>+2<p>+90<p>+5</article><footer>-9</footer>
<nav><ul><li><a>-1</a><li><a>-1</a></ul></nav><div class=ad>-12</div><article><h1>+1</h1><p>+1<p>+1<p>+300</article><footer>-5</footer>
<nav><a>-1</a><a>-1</a></nav><div class=ad>-3</div><article><h1>+12</h1><p>+250<p>+2</article><footer>-14</footer>
<header><h1>-2</h1><a>-1</a></header><nav><a>-4</a></nav><article><header><h2>+6</h2><p>+4</header><p>+35<p>+9<aside>-6</aside><p>+50<div class=ad>-20</div><p>+7<ul><li>+4<li>+12<li>+2</ul><p>+22</article><section id=comments><h3>-2</h3><article><p>-30</article><article><p>-8</article></section><footer>-6<a>-4</a></footer>
<header><a>-1</a>-3</header><main><h1>+9</h1><p>+70<p>+20<a>+10</a><p>+40<blockquote>+18</blockquote><p><a>+8</a><p>+65<table><tr><td>+2<td>+1<tr><td>+3<td>+1</table></main><aside><h3>-2</h3><ul><li><a>-5</a><li><a>-6</a></ul><p>-40</aside><footer>-11</footer>
<article><h1>+7</h1><ul><li><a>-3</a><li><a>-4</a><li><a>-2</a><li><a>-3</a></ul><p>+55<p>+80<h2>+3</h2><p>+44<a>+2</a></article>
<article><p>+1</article>
<nav><a>-2</a></nav><article><h1>+4</h1><p>+40<p>+7</article>
<nav><a>-1</a></nav><article><h1>+5</h1><p>+14<p>+3</article>
<article><h1>+3</h1><p>+60<p>+13</article>
<article><h1>+2</h1><p>+18</article>
<article><h1>+6</h1><p>+35<p>+4</article><div><a>-5</a></div><div><a>-7</a></div>
<article><p>+5<p>+2</article><ul><li><a>-3</a><li><a>-4</a></ul>
<main><p>+22<h2>+1</h2><p><a>+4</a><p>+6</main><div><a>-3</a>-1</div>
<main><h1>+2</h1><p>+9<a>+1</a></main>
<article><p>+15<h2>+2</h2><h2>+3</h2><p>+6<ul><li>+1<li>+1<li>+5</ul><p><a>+3</a><p>+33</article>
<article class=post-share><p>+120<p>+3</article><form><label>-2</label></form>
<div><ul><li><a>-1</a><li><a>-1</a><li><a>-2</a><li><a>-1</a></ul></div><h1>+9</h1><p>+40<p>+75<p>+12<p>+33<div>-4<a>-3</a></div><div>-6</div>
<div><ul><li><a>-2</a><li><a>-1</a><li><a>-1</a></ul></div><div><h1>+6</h1><p>+28<p>+60<ul><li>+8<li>+14<li>+6</ul><p>+45</div><ul><li><a>-4</a><li><a>-3</a><li><a>-5</a></ul><p>-7</p>
<div><a>-2</a></div><div><a>-2</a></div><h1>+8</h1><p>+60<p>+60<div><a>-1</a>-1<a>-1</a></div>
<p>+37</p><div><a>-6</a></div>
<p>+42</p><p>+25</p><div><a>-3</a></div><div><a>-4</a></div>
<div><a>-1</a></div><p>+30</p><div><a>-2</a></div>
<div><a>-10</a></div><p>+55</p><p>+18</p><div><a>-12</a></div><div>-3</div>
<div>-2<a>-4</a></div><h2>+5</h2><p>+90</p><p>+4</p><p>+85</p><div>-3<a>-6</a></div><div>-4</div>
<table><tr><td><a>-1</a><td><a>-1</a><td><a>-2</a></table><p>+100</p><p>+26<a>+3</a></p><p>+50</p><table><tr><td><a>-2</a><td><a>-1</a></table><p>-5</p>
<h3>-3</h3><ul><li><a>-5</a><li><a>-7</a><li><a>-6</a></ul><h3>-2</h3><ul><li><a>-4</a><li><a>-8</a></ul><div>-5</div>
<ul><li><a>-5</a>-3<li><a>-7</a>-2<li><a>-6</a>-4</ul><h3>-2</h3><div>-8<a>-12</a></div>
<div><a>-15</a></div><div><a>-22</a>-3</div><div><a>-18</a>-2</div><div>-4</div>
<div class=share-story><h1>+6</h1><p>+80<p>+40<p>+7<p>+66</div><div class=ad>-10</div><div>-5</div>
<div class=sidebar-left-page><p>+35<p>+150<p>+3<p>+20</div><div class=cookie-notice>-16</div>
<form><h1>+4</h1><p>+60<p>+30<p>+55</form><footer>-8</footer>
<div class=content-header-wrap><h1>+7</h1><p>+25<p>+90</div><div class=related><a>-6</a></div><div class=related><a>-9</a></div>
<div class=cookie-notice>-20</div><h1>+5</h1><p>+110<p>+8<p>+60<div class=newsletter>-25</div><div class=share><a>-1</a><a>-1</a></div><div class=comments><p>-40<p>-12<p>-55</div>
<div class=ad>-45</div><p>+200<p>+150<div class=promo><h3>-4</h3><p>-30</div><footer><p>-35</footer>
<div class=banner>-60</div><article><p>+180<p>+90</article><div class=sponsored><p>-50<a>-3</a></div>
<aside><p>-90<p>-60</aside><p>+70<p>+40<footer>-20</footer>
<nav><p>-40</nav><h1>+3</h1><p>+20<p>+22<p>+35<footer><p>-50<p>-25</footer>
<section class=comments><p>-120<p>-90<p>-60</section><h1>+6</h1><p>+30<p>+45
<div class=menu><p>-6</div><div class=login><p>-9<a>-2</a></div><p>+48<p>+5<p>+52<div class=pager><a>-1</a><a>-1</a></div>
<h1>+7</h1><p>+16<p>+24<p>+19<p>+31<p>+11<p>+27<div>-3</div>
<p>+21<p>+14<p>+40<h2>+4</h2><p>+38<h2>+2</h2><p>+29<div><a>-2</a></div>
"""

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
HIDDEN = frozenset("script style noscript template iframe object svg math canvas audio video head title textarea select option button datalist".split())
#: Elements that hold no main text, unless an article stands in them: and those that hold none at all.
MARKED = frozenset("header form fieldset".split())
NEVER = frozenset("nav footer aside menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("li td th dt dd".split())
#: Words in class and id names that tell what is not main text.
HINTS = re.compile(r"(?<![a-z])(?:ads?|adverts?|advertisements?|banner|sponsor(?:ed)?|promo(?:tion)?s?|cookies?|consent|notice|alert|popup|modal|nav(?:bar|igation)?|menu|breadcrumbs?|header|masthead|footer|sidebar|widget|related|recommend(?:ed|ations)?|share|sharing|social|newsletter|subscribe|comments?|replies|respond|disqus|login|search|pagination|pager)(?![a-z])", re.I)
READERS = re.compile(r"(?<![a-z])(?:comments?|replies|respond|disqus)(?![a-z])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|noscript|template|iframe|textarea|svg|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


#: How elements are marked: hidden, never main text, marked by a name or class, not at all, article.
HIDES, NOT, NAMED_SO, PLAIN, ARTICLE = -3, -2, -1, 0, 1


@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: bool
    item: bool
    mark: int
    box: int  # the outermost marked element around it, 0: none


def mark_of(tag: str, attributes: str, mark: int) -> int:
    """An element's mark, within one with the mark given. An article's own header is part of it."""
    if mark <= NOT:
        return mark
    if tag in HIDDEN:
        return HIDES
    if tag in NEVER:
        return NOT
    hinted = tag in MARKED and not (tag == "header" and mark == ARTICLE)
    article = tag in ("article", "main")
    if attributes and tag not in ("html", "body"):
        for name, value in NAMED.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                return HIDES
            if name == "role" and value.lower() in ROLES or name in ("class", "id") and READERS.search(value):
                return NOT
            if name in ("class", "id") and HINTS.search(value) and not (mark == ARTICLE and re.fullmatch(r".*header.*", value, re.I)):
                hinted = True
        article = article or "itemprop" in attributes and "articlebody" in attributes.lower()
    return ARTICLE if article else NAMED_SO if hinted else mark


def page_blocks(page: str) -> list[Block]:
    """Blocks of text in page order, with character references decoded and white space turned into single spaces."""
    blocks: list[Block] = []
    parts: list[str] = []
    linked, boxes = 0, 0
    stack: list[tuple[str, int, int]] = []  # open elements, their marks and boxes
    in_link, block_tag = False, ""

    def close() -> None:
        nonlocal linked
        mark, box = stack[-1][1:] if stack else (PLAIN, 0)
        words = html.unescape("".join(parts)).split() if parts and mark != HIDES else []
        parts.clear()
        if words:
            blocks.append(Block(" ".join(words), len(words), min(linked, len(words)), block_tag in HEADINGS, block_tag in ITEMS, mark, box))
        linked = 0

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
            if in_link:
                linked += len(parts[-1].split())
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag == "a":
            in_link = not m[2]
            continue
        if tag in INLINE:
            continue
        if tag == "br" or tag in VOID and tag != "hr":
            parts.append(" ")
            continue
        close()
        if tag in VOID:
            continue
        if m[2]:
            in_link = False
            block_tag = ""
            if any(x[0] == tag for x in stack):
                while stack.pop()[0] != tag:
                    pass
        else:
            block_tag = tag
            while stack and (stack[-1][0] == "p" or tag in ITEMS and stack[-1][0] == tag or stack[-1][0] in HEADINGS and tag in HEADINGS):
                stack.pop()  # these end where the next begins
            _, above, box = stack[-1] if stack else ("", PLAIN, 0)
            mark = mark_of(tag, m[4], above)
            if mark < PLAIN and above >= PLAIN:
                boxes += 1
                box = boxes
            elif mark >= PLAIN:
                box = 0
            if not m[4].rstrip().endswith("/"):
                stack.append((tag, mark, box))
    if at < len(page):
        parts.append(page[at:])
        if in_link:
            linked += len(parts[-1].split())
    close()
    return blocks


def block_features(blocks: list[Block]) -> np.ndarray:
    n = len(blocks)
    own = np.array([[b.words, 100 * b.linked // b.words] for b in blocks], float).reshape(n, 2)
    none = np.zeros((1, 2))
    box, plain = np.array([b.box for b in blocks], int), np.array([b.words - b.linked for b in blocks], float)
    held = np.bincount(box, plain) if n else np.zeros(1)
    share = np.where(box > 0, np.floor(100 * held[box] / max(1.0, plain.sum())), 0.0)
    rest = np.array([[b.heading, b.item, b.mark] for b in blocks], float).reshape(n, 3)
    return np.hstack([own, np.vstack([none, own])[:n], np.vstack([own, none])[1:], rest, share[:, None]])


def labelled_blocks(pages: str = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Features of the blocks of pages in the labelled table's notation, and whether each is main text."""
    x, y = [], []
    for page in pages.strip().splitlines():
        blocks = page_blocks(re.sub(r"([+-])(\d+)", lambda m: f" {' '.join([m[1]] * int(m[2]))} ", page))
        x.append(block_features(blocks))
        y += [b.text[0] == "+" for b in blocks]
    return np.vstack(x), np.array(y, float)


# ---- the tree ----


def grown(x: np.ndarray, y: np.ndarray, depth: int, least: int = 1) -> tuple:
    """(feature, threshold, left, right), or the share of ones in a leaf; splits by Gini impurity."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return (share,)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            left = x[:, f] <= cut
            a, b = y[left], y[~left]
            if min(len(a), len(b)) < least:
                continue
            impurity = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(cut), left)
    if best is None:
        return (share,)
    _, f, cut, left = best
    return f, cut, grown(x[left], y[left], depth - 1, least), grown(x[~left], y[~left], depth - 1, least)


def trained_tree(pages: str = LABELLED, depth: int = 8) -> tuple:
    return grown(*labelled_blocks(pages), depth)


def classified(tree: tuple, x: np.ndarray) -> np.ndarray:
    """Whether each row is main text."""
    if len(tree) == 1:
        return np.full(len(x), tree[0] >= 0.5)
    f, cut, left, right = tree
    out, low = np.zeros(len(x), bool), x[:, f] <= cut
    if low.any():
        out[low] = classified(left, x[low])
    if not low.all():
        out[~low] = classified(right, x[~low])
    return out


def main_text(page: str, tree: tuple) -> str:
    blocks = page_blocks(page)
    if not blocks:
        return ""
    return " ".join(b.text for b, ok in zip(blocks, classified(tree, block_features(blocks)), strict=True) if ok)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", tree: tuple | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for each page; null or empty html, or none classified as main text, gives an empty text.

    Whole pages are read, however long. Repeated rows, null ids and null urls are pages like others; an empty table gives
    an empty result; other columns are not read.
    """
    tree = tree or trained_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for b in batches:
            texts = [main_text(page, tree) for page in strings(b.column(2)).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr(f"cast(`{id_col}` as long) page_id", f"`{url_col}` url", f"`{html_col}` html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
