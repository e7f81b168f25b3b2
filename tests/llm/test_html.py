import re
import time
from html import unescape

import pytest

from tessera.llm import html as h


def article(page):
    """Brute force for the table's pages: the article element, block by block."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    parts = [re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(p for p in parts if p)


def test_table(spark, sf01):
    pages = spark.read.parquet(f"{sf01}/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    got = h.extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want and len(got) == len(want)
    assert all(r["n_chars"] == len(r["text"]) for r in got)


PAGE = """<html><body><div class="wrap"><div class="top"><span>The Daily</span></div><div id="x">Your account</div>
<div class="body"><h2>Title {n}</h2><p>First &amp; text {n}<br>of this page.<p>Second   paragraph {n}</div>
<div class="end">All rights kept by us</div></div></body></html>"""


@pytest.fixture
def make_pages(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'a' AS host", "'b' AS text", "1 AS __x", "2 AS token", "3 AS slot")

    return make


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


@pytest.mark.parametrize("bound", [h.BROADCAST_BYTES, 0])
def test_template_without_main_element(make_pages, bound):
    rows = [(i, f"https://u@H.org:80/p/{i}", PAGE.format(n=i)) for i in range(6)] + [(100, "https://h.org/copy", PAGE.format(n=0))]
    rows += [(200, "http://other.org", PAGE.format(n=7)), (300, None, PAGE.format(n=8))]
    got = texts(h.extract(make_pages(rows), broadcast_bytes=bound))
    for i in range(6):
        assert got[i] == f"Title {i}\n\nFirst & text {i} of this page.\n\nSecond paragraph {i}"
    assert got[100] == got[0]
    assert "Title 7" in got[200] and "Title 8" in got[300]


def test_only_copies_are_no_template(make_pages):
    rows = [(i, "http://h.org/", PAGE.format(n=1)) for i in range(9)]
    assert set(map(len, texts(h.extract(make_pages(rows))).values())) == {len(h.main_text(PAGE.format(n=1)))}


def test_root_class_inside_the_article(make_pages):
    """The same page gives the same text however many pages its host has."""
    page = "<body><article><p>Own text {n}</p><p>Shown everywhere</p></article></body>"
    for k in (h.LEAST_PAGES, 7, 8, 20):
        got = texts(h.extract(make_pages([(i, f"http://k.org/{i}", page.format(n=i)) for i in range(k)])))
        assert got == {i: f"Own text {i}" for i in range(k)}


def test_table_without_main_elements(spark, sf01):
    """The table's pages with the article element taken away, gathered on
    twelve hosts that add a frame of plain blocks: there the template decides."""
    frame = "<div class='w'><div class='t'>Site {k} welcomes you back</div><div class='s'><span>Write to office {k}</span></div>"
    rows = spark.read.parquet(f"{sf01}/pages.parquet").collect()
    pages, want = [], {}
    for r in rows:
        k = r["page_id"] % 12
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        pages.append((r["page_id"], f"http://site{k}.org/{r['page_id']}", "<html><body>" + frame.format(k=k) + f"<div class='c'>{body}</div><div class='b'>All rights stay with site {k}</div></div></body></html>"))
        want[r["page_id"]] = article(r["html"])
    got = texts(h.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)))
    alone = {i: h.main_text(html) for i, _, html in pages}  # templates off
    assert all("welcomes you back" in t and "All rights stay" in t for t in alone.values())
    assert got == want


@pytest.mark.parametrize("changed", ["<p>Seen on day {n}</p>", "</article><p>token {n}</p><article>", "<script>{n}</script>", "<p>Rewritten words of version {n}, longer than all the others</p>" * 4])
def test_versions_of_one_article_keep_their_text(make_pages, changed):
    page = "<body><article><h1>One title</h1><p>First paragraph</p>" + changed + "<p>Second paragraph</p></article></body>"
    got = texts(h.extract(make_pages([(i, f"http://v.org/{i}", page.format(n=i)) for i in range(10)])))
    assert got == {i: h.main_text(page.format(n=i)) for i in got} and "First paragraph" in got[3] and "Second paragraph" in got[3]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("plain  text", "plain text"), ("<article>a <b>b</b>\n<i>c</i><p>d<p>e</article>", "a b c\n\nd\n\ne"),
        ("<article>x<script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no</p> -->y</article>", "xy"),
        ("<main><nav>menu</nav><header>top</header><h1>T</h1><p>One</p><aside>side</aside><form>f</form><footer>end</footer></main>z", "T\n\nOne"),
        ('<article><div class="ad-box">buy</div><p class="cookie-notice">ok</p><p>text</p><section id="comments"><article class="comment"><p>hi</p></article></section></article>', "text"),
        ('<div role="main"><p>&lt;a&gt; &eacute;&#233;&nbsp;x</p></div><div>out</div>', "<a> éé x"),
        ("<article><ul><li>1<li>2</ul><table><tr><td>a<td>b</table></article>", "1\n\n2\n\na\n\nb"), ("<article><p>unclosed", "unclosed"),
        ('<article><p title="a > b">q</p></article>', "q"), ("<article><p>a</div>b</article>c", "a\n\nb"), ("<article>a</article><article>b</article>", "a\n\nb"), ("<!-- open <p>x", ""),
        ("<body class='nav-open'><article class='single sidebar-less'>t</article></body>", "t"), ("<div class='layout sidebar-right'><div class='menu'>m</div><article>t<p class='menu'>n</p></article></div>", "t"),
        ("<div id='comments'><article>hi</article></div><div class='sidebar'>s</div><p>text", "text"),
    ],
)
def test_markup(page, want):
    assert h.main_text(page) == want


def test_empty_and_clashing_columns(make_pages):
    assert h.extract(make_pages([])).collect() == []
    got = h.extract(make_pages([(1, "http://a.org", None), (1, "http://a.org", None), (None, "http://a.org", "<p>x")]))
    assert got.columns[:4] == ["page_id", "url", "text", "n_chars"] and sorted(r["text"] for r in got.collect()) == ["", "", "x"]


def test_long_pages_are_linear():
    began = time.time()
    for page in ("<p>" * 100_000, "<" * 300_000, "<a '" * 60_000, "<!--" * 80_000, "<script>" * 40_000, "x " * 400_000, "<li>" * 50_000, "&" * 300_000):
        h.main_text(page)
    assert time.time() - began < 40
