import re
from collections import Counter
from html import unescape

from wardstat.llm import html_blocks
from wardstat.llm.common import table

from tests.llm.helpers import SF

TREE = html_blocks.default_tree()
SHELL = "<html><head><title>no</title><style>p{}</style></head><body>%s</body></html>"


def main_text(body):
    return html_blocks.main_text(SHELL % body, TREE)


def test_tree_fits_its_table():
    import numpy as np

    rows = np.array(html_blocks.LABELLED, float)
    density = [rows[:, k + 1] / np.maximum(rows[:, k], 1) for k in (0, 2, 4)]
    x = np.stack([rows[:, 0], density[0], rows[:, 2], density[1], rows[:, 4], density[2], *rows[:, 6:9].T], axis=1)

    def leaf(node, row):
        while isinstance(node, html_blocks.Node):
            node = node.low if row[node.feature] <= node.limit else node.high
        return node >= 0.5

    assert sum(leaf(TREE, r) == bool(y) for r, y in zip(x, rows[:, 9])) >= 0.95 * len(rows)


def test_article_without_its_surroundings():
    body = (
        '<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div id="cookie-notice">We use cookies on this site.</div>'
        '<div class="ad">Buy this now</div><article><header><h1>Ti&amp;tle</h1></header><p>First <b>bo</b>ld&nbsp;para\n graph.<br>x</p>'
        '<aside>Side</aside><p>a &lt; b</p><form><input><label>Mail</label></form><script>var a="</p><p>no";</script>'
        '<section class="post-comments"><p>Nice article, thanks a lot!</p></section><p><a href="x">all of it linked</a></p></article>'
        '<div class="comments"><p>reader</p></div><div class="sidebar">more</div><footer>&copy; site</footer><!-- <p>no</p> -->'
    )
    assert main_text(body) == "Ti&tle First bold para graph. x a < b all of it linked"


def test_pages_without_an_article_element():
    text = "This is a paragraph of the main text and it has many more words than any of the menus around it. " * 3
    body = f'<ul><li><a href="a">One</a></li><li><a href="b">Two</a></li></ul><div><p>{text}</p><p>{text}</p></div><div class="footer">(c) us</div>'
    assert main_text(body) == " ".join((text + text).split())


def test_broken_markup_and_plain_text():
    assert html_blocks.main_text("", TREE) == "" and main_text("") == ""
    assert main_text("<article><p>a < b and c > d<p>e</article>") == "a < b and c > d e"
    assert main_text('<article><p title="x > y">in</p></div></nav><b>open<p>q</article>') == "in open q"
    assert main_text("<article>t" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "t deep"


def test_test_pages_give_their_articles(spark):
    pages = table(spark, SF, "pages")
    got = {r["page_id"]: r["text"] for r in html_blocks.extract(pages).collect()}
    for page_id, html in pages.select("page_id", "html").collect():
        inner = re.search(r"<article>(.*)</article>", html, re.S).group(1)
        inner = re.sub(r"</?(p|h\d|br|ul|li)[^>]*>", " ", inner)
        assert got[page_id] == " ".join(unescape(re.sub(r"<[a-zA-Z/!][^>]*>", "", inner)).split())


def test_rows_of_all_kinds(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<article>é 日本</article>"), (2, "v", "x" * 300_000)]
    pages = spark.createDataFrame([(*r, 1, "c0") for r in rows], "page_id long, url string, html string, n_chars int, c0 string")
    got = Counter(tuple(r) for r in html_blocks.extract(pages).collect())
    assert got == Counter({(1, "u", "", 0): 2, (None, None, "é 日本", 4): 1, (2, "v", "x" * 300_000, 300_000): 1})
    assert html_blocks.extract(pages.limit(0)).count() == 0


def test_left_out_end_tags_lose_no_article():
    for page in (
        "<html><head><title>no</title><meta charset=x><body><article><p>in</article>",
        "<title>no</title><script>a</script><article><p>in</article>",
        "<article><svg class='i' width=1/><p>in</p></article><footer><svg><path/></svg></footer>",
        "<article><svg><path d='M0'/><p>in</p></article><footer><svg><path/></svg></footer>",
        "<article><button>no<p>in</p></article><footer><button>x</button></footer>",
        "<article><math><mi>no</mi><p>in</article>",
    ):
        assert html_blocks.main_text(page, TREE) == "in", page
    assert main_text("<article>a<svg><text>no</text></svg>b<script>if (a<b) '<script>'</script>c<select><option>no</select></article>") == "a b c"


def test_wrappers_do_not_hide_the_article():
    for wrap in ("<div class='content-sidebar-wrap'>", "<div class='site has-banner'>", "<form id='aspnetForm'>"):
        assert main_text(f"{wrap}<main><article><p>in</p><aside>no</aside></article></main><div class='sidebar'>no</div>") == "in"
    for wrap in ("<div class='comments'>", "<ol class='comment-list'>", "<aside>", "<nav>", "<div class='related-posts'>", "<div class='sidebar'>"):
        assert main_text(f"<article><p>in</p></article>{wrap}<article><p>no</p></article>") == "in", wrap
