import html
import itertools
import re

import duckdb

from purchase_signals.llm import dom
from purchase_signals.llm import wrappers as W
from purchase_signals.llm.queries import QUERIES


def text_of(page):
    return [t for t, *_ in W.blocks_of(page, None)[0]]


def test_given_pages_against_their_article_elements(spark):
    sf = "/root/testdata/sf0.01"
    pages = {p: (u, h) for p, u, h in duckdb.sql(f"SELECT page_id, url, html FROM '{sf}/pages.parquet'").fetchall()}
    got = QUERIES["op4_html_extraction"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        url, page = pages[r.page_id]
        article = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>?", "", b)).split()) for b in re.split(r"</?p>|</?h1>", article)]
        want = "\n\n".join(b for b in blocks if b)
        assert (r.url, r.text, r.n_chars) == (url, want, len(want))


def test_boilerplate_elements_and_words():
    page = """<body><header>H</header><nav>N</nav><div class="cookie-notice">C</div><main><header><h1>Title</h1></header>
    <p>One&nbsp;&amp; two<br>three <a href=x>link</a>.<p>Four <b>five</i></b><ul><li>six<li>seven</ul><div class="share">S</div>
    <form>F<p>f</form><script>if (a<b) "</p>"</script><table><tr><td>c1<td>c2</table><pre>x
    y</pre><!-- <p>gone --><div id="comments"><p>bad</div></main><aside>A</aside><footer>E</footer>"""
    assert text_of(page) == ["Title", "One & two three link.", "Four five", "six", "seven", "c1", "c2", "x y"]


def test_pages_without_main_part_lose_link_lists():
    page = "<div><a href=1>one</a> <a href=2>two</a></div><div>Real text with <a href=3>a link</a> in it.</div>"
    assert text_of(page) == ["Real text with a link in it."]


def test_linked_headings_and_single_links_stay():
    page = "<h1><a>Title</a></h1><p>Text</p><p><a>One link</a></p><p>More</p><ul><li><a>a</a><li><a>b</a></ul><h2><a>Part</a></h2><p>End</p>"
    assert text_of(page) == ["Title", "Text", "One link", "More", "Part", "End"]


def test_wrappers_with_boilerplate_words_keep_the_article():
    for wrap in ('div class="layout has-sidebar"', 'div class="no-sidebar"', 'div class="header-fixed"', 'form id="aspnetForm"', 'div class="widget"',
                 'div class="sidebar"', "aside", "nav", 'div role="complementary"'):
        tag = wrap.split()[0]
        assert text_of(f"<nav>N</nav><{wrap}><article><h1>T</h1><p>Text</p></article></{tag}>") == ["T", "Text"], wrap
    for wrap in ('div class="elementor-widget-container"', 'div class="widget"', 'section class="notice"', "form"):
        tag = wrap.split()[0]
        assert text_of(f"<article><h1>T</h1><{wrap}><p>Text of the page</p></{tag}></article><article>Two</article>") == ["T", "Text of the page", "Two"], wrap
        assert text_of(f"<footer>F</footer><{wrap}><p>Text of the page</p><p>More</p></{tag}><p>End</p>") == ["Text of the page", "More", "End"], wrap


def test_boilerplate_with_articles_of_its_own_stays_outside():
    page = """<form id="aspnetForm"><main><article><p>Short</p></article><div id="comments"><article>A long comment, longer than all</article></div></main>
    <div class="sidebar-left"><article>Teaser</article></div><div class="site-footer">F</div></form><div hidden><article>H</article></div>"""
    assert text_of(page) == ["Short"]
    assert text_of('<div class="main-nav">N</div><div class="site-header">H</div><p>Text of its own</p><div class="post-comments">C</div>') == ["Text of its own"]


def test_broken_pages():
    for page, want in {"": [], "plain": ["plain"], "a < b &lt; c &#x41;&am": ["a < b < c A&am"], "<p>x<p": ["x"], "</div><p>x</p></p>y": ["x", "y"],
                       "<script>never closed <p>x": [], "<!-- open": [], "<p title='>'>q</p>": ["q"], "<div " * 5: []}.items():
        assert text_of(page) == want, page
    assert text_of("<div>" * 20000 + "deep") == ["deep"]


def small_trees(depth):
    if depth == 0:
        return [["a", 1, 1, []], ["b", 1, 1, []]]
    kids = small_trees(depth - 1)
    return [["a", 1, 1, list(c)] for n in range(3) for c in itertools.product(kids, repeat=n)]


def size_of_best(a, b):
    """By brute force over all ways to leave children out."""
    if a[0] != b[0]:
        return 0
    best = 0
    for n in range(min(len(a[3]), len(b[3])) + 1):
        for x in itertools.combinations(a[3], n):
            for y in itertools.combinations(b[3], n):
                best = max(best, sum(size_of_best(i, j) for i, j in zip(x, y)))
    return 1 + best


def test_simple_tree_matching_is_maximal():
    trees = small_trees(2)[::3]
    for a, b in itertools.product(trees, repeat=2):
        n, pairs = dom.match(dom.tree(a), dom.tree(b))
        assert n == size_of_best(a, b) == len(pairs)
        assert all(x.label == y.label for x, y in pairs)


def test_constant_slots_are_template(spark):
    rows = [(i, "http://h.example/x", f"<body><div class=top>Welcome to H</div><div class=txt><p>Story number {i} with words of its own.</p></div>"
             "<p class=end>All rights</p>") for i in range(20)]
    rows += [(100 + i, "http://same.example/", "<body><div>One</div><p>and the same</p>") for i in range(9)]
    rows += [(200, None, None), (201, "", ""), (None, "x", "<p>q")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, text int")
    got = {r.page_id: r.text for r in W.extract(df.repartition(3)).collect()}
    assert all(got[i] == f"Story number {i} with words of its own." for i in range(20))
    assert all(got[100 + i] == "One\n\nand the same" for i in range(9))
    assert (got[200], got[201], got[None]) == ("", "", "q")
    assert W.extract(df.limit(0)).count() == 0


def sections(i, n):
    return "".join(f"<h2>Part {k} of {i}</h2><p>Text {k} of page {i}</p>" for k in range(n))


def test_pages_over_the_cap_are_aligned(spark):
    page = "<body><div class=top>Welcome to H</div><div class=txt>{}</div><p class=end>All rights</p>"
    rows = [(i, "http://h.example/", page.format(sections(i, 2500 if i % 7 == 3 else 3 + i % 3))) for i in range(20)]
    rows += [(-2, "http://h.example/", ""), (-1, "http://h.example/", page.format(sections(-1, 2500)))]
    rows += [(100 + i, "http://deep.example/", page.format("<div>" * 150 + f"Story {i} as told at length")) for i in range(9)]
    out = W.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4))
    got = {r.page_id: r.text for r in out.collect()}
    for i in range(-1, 20):
        n = 2500 if i % 7 == 3 or i < 0 else 3 + i % 3
        assert got[i] == "\n\n".join(f"Part {k} of {i}\n\nText {k} of page {i}" for k in range(n)), i
    assert all(got[100 + i] == f"Story {i} as told at length" for i in range(9)) and got[-2] == ""


def test_large_and_deep_trees_are_paired():
    deep = dom.read("<div>" * 20000 + "x")[0]
    assert len(dom.align(dom.unflat(deep.flat()), deep, 4000)) == dom.number(deep)
    assert [r[:3] for r in dom.unflat(deep.flat()).flat()] == [r[:3] for r in deep.flat()]
    a, b = (dom.read(f"<div>top</div>{sections(i, n)}<div class=x>end</div>")[0] for i, n in ((1, 9), (2, 5)))
    pairs = dom.align(a, b, 2)
    assert len(pairs) == 13 and all(x.label == y.label for x, y in pairs)
    assert sorted(x.label for x, y in pairs if x.text == y.text) == ["div", "div.x"]
