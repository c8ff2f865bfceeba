import re
from collections import Counter
from html.parser import HTMLParser

from tallyloom.llm.html_blocks import FEATURES, block_features, classified, extract_main_text, labelled_blocks, main_text, page_blocks, trained_tree

TREE = trained_tree()


class Article(HTMLParser):
    """Text of article elements, by another parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag not in ("b", "i", "a", "em"):
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag not in ("b", "i", "a", "em"):
            self.parts.append(" ")

    def handle_data(self, data):
        if self.depth:
            self.parts.append(data)


def by_parser(page):
    p = Article()
    p.feed(page)
    p.close()
    return " ".join("".join(p.parts).split())


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in extract_main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        if "</article>" in r.html:
            assert got[r.page_id].text == by_parser(r.html)
        else:
            assert got[r.page_id].text[:200] == by_parser(r.html)[:200]
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def used(tree):
    return set() if len(tree) == 1 else {FEATURES[tree[0]]} | used(tree[2]) | used(tree[3])


def test_tree_fits_its_table():
    x, y = labelled_blocks()
    assert len(y) > 250 and (classified(TREE, x) == (y > 0.5)).mean() >= 0.99
    assert {"words", "links", "mark", "share"} <= used(TREE) and used(TREE) & {"words_before", "links_before", "words_after", "links_after"}
    for mark in (-1, 0, 1):  # how a block is marked decides nothing by itself
        assert 0 < y[x[:, 8] == mark].mean() < 1


def test_without_semantic_elements(spark, sf):
    """Words of articles whose pages say nothing of where they stand: found by words and links alone."""
    hit = found = there = 0
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        if "</article>" not in r.html:
            continue
        want = by_parser(r.html).split()
        plain = re.sub(r"(</?)(article|nav|footer)", r"\1div", r.html).replace(' class="ad"', "")
        got = main_text(plain, TREE).split()
        hit += sum((Counter(got) & Counter(want)).values())
        found, there = found + len(got), there + len(want)
    assert hit / found > 0.95 and hit / there > 0.95, (hit / found, hit / there)


def test_pages_that_name_nothing():
    long = " ".join(f"w{i}" for i in range(37))
    assert main_text(f"<body><p>{long}</p><div><a href=x>one two three four five</a></div></body>", TREE) == long
    menu = "<div><ul><li><a href=1>Home</a><li><a href=2>News</a><li><a href=3>About</a></ul></div>"
    assert main_text(f"<body>{menu}<h1>The title of this page</h1><p>{long}</p><p>{long}</p></body>", TREE) == f"The title of this page {long} {long}"
    assert main_text(f'<body><div class="share-story"><article><h1>Title</h1><p>{long}</p></article></div><div class="share">Share this</div></body>', TREE) == f"Title {long}"
    assert main_text(f'<body><div class="share-story"><p>{long}</p><p>{long}</p></div></body>', TREE) == f"{long} {long}"
    assert main_text(f'<body><p>{long} {long}</p><div class="advert"><p>{long[:60]}</p></div></body>', TREE) == f"{long} {long}"


def test_articles_that_end_in_a_short_paragraph():
    words = lambda n: " ".join(f"w{i}" for i in range(n))
    for mark in ("article", "main"):
        assert main_text(f"<{mark}><h1>A title</h1><p>{words(60)}</p><p>{words(10)} END</p></{mark}>", TREE) == f"A title {words(60)} {words(10)} END"
        assert main_text(f"<{mark}><p>{words(60)}</p><p>The end is here now.</p></{mark}>", TREE) == f"{words(60)} The end is here now."
    assert main_text("<article><p>a&nbsp;&nbsp;b &lt;c&gt;</p></article>", TREE) == "a b <c>"


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><a href="/">Home</a></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies on this site to make it work well for everybody here.</div>
<article><header><h2>A title</h2></header><p>First &amp; second &#233;t&eacute;<br>line&nbsp;end.<p>Short.<aside>Buy this now</aside><div class=ad>Advert</div>
<form><label>Mail</label><input name=x><button>Send</button></form><ul><li>item one</li><li>item <b>tw</b>o</li></ul><script>if (a<b) "</p>"</script></article>
<section id="comments"><article><p>I am a reader and I say this is a long comment with many words in it.</p></article></section>
<footer>&copy; 2020 Someone who made the site</footer></body></html>"""


def test_what_stays():
    assert main_text(PAGE, TREE) == "A title First & second été line end. Short. item one item two"


def test_plain_pages_by_density():
    words = "word " * 60
    page = f"<body><div><a href=1>a b</a></div><div><a href=2>c d</a></div><h1>The heading of it all here</h1><p>{words}</p><p>{words}</p><div><a href=3>e</a> | <a href=4>f</a></div></body>"
    text = main_text(page, TREE)
    assert text.split() == "The heading of it all here".split() + ["word"] * 120


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "no tags at all"), (None, "u", "<article>x"), (5, "u", "<article><p>cut off <b"), (5, "u", "<article><p>cut off <b"), (6, "u", "<a " * 2000), (7, "u", "<article><p>" + "long " * 200000 + "</p></article>"), (8, "u", "</div></p><p></p>")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, n_chars int")
    got = sorted(((r.page_id, r.url, re.sub("(long ?){9,}", "L", r.text)) for r in extract_main_text(frame).collect()), key=str)
    assert [x for x in got if x[0] != 3] == sorted([(1, "u", ""), (2, None, ""), (None, "u", "x"), (5, "u", "cut off"), (5, "u", "cut off"), (6, "u", ""), (7, "u", "L"), (8, "u", "")], key=str)
    assert extract_main_text(frame.limit(0)).count() == 0
    assert block_features(page_blocks("<p>a</p>")).shape == (1, len(FEATURES))
