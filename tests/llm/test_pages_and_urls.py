"""Main text of pages, and URL filters."""

import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from urbanflow.llm import html_extraction
from urbanflow.llm.html_blocks import Page
from urbanflow.llm.html_extraction import main_text, style_tree
from urbanflow.llm.url_filters import host_of, path_of, url_filter, validity


def page(body):
    return f"<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


PAGES = {
    "article": (page("<nav><a href=/>Home</a></nav><header>Site</header><article><header><h1>A &amp; B</h1></header><p>One\n two<p>Three<br>four"
                     "<aside>more</aside><ul><li>x<li>y</ul></article><footer>f</footer>"), "A & B\nOne two\nThree four\nx\ny"),
    "comments": (page('<main><p>Text.</p><div class="comments"><p>Nice!</p></div><form><p>Send</p></form></main><div id="cookie-notice">ok</div>'), "Text."),
    "plain": (page("<h1>Title</h1><div class='sidebar'>s</div><div><p>Body&nbsp;text &#169; &lt;b&gt;</p></div>"), "Title\nBody text © <b>"),
    "table": (page("<article><table><tr><td>a<td>b<tr><td>c</table></article>"), "a\nb\nc"),
    "broken": ("<article><p>cut <b>off &am", "cut off &am"),
    "script": (page('<script>var t="</p>";x<y</script><article><p>kept</p><script>no</script></article>'), "kept"),
    "bare": ("just text", "just text"),
    "empty": ("", ""),
    "null": (None, ""),
}


def test_main_text(spark):
    rows = [(i, f"https://h{i}.example/p", PAGES[k][0]) for i, k in enumerate(PAGES)] + [(None, None, PAGES["article"][0])] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as key", "2 as blocks", "3 as host")
    got = main_text(df).collect()
    assert len(got) == len(rows)
    for r in got:
        text = PAGES[list(PAGES)[r.page_id] if r.page_id is not None else "article"][1]
        assert (r.text, r.n_chars) == (text, len(text))


LAYOUTS = {
    '<div class="content-sidebar-wrap"><article><p>Text.</p></article><div class="sidebar">s</div></div>': "Text.",
    '<p>Some site</p><div id="page" class="with-sidebar"><main><p>Text.</p></main><footer>f</footer></div>': "Text.",
    '<form id="aspnetForm"><nav>n</nav><article><h1>T</h1><p>Text.</p></article></form>': "T\nText.",
    '<form id="aspnetForm"><div id="content"><p>Text.</p><div class="share">Share</div></div></form>': "Text.",
    "<p>x</p><article><p>One.</p></article><article><p>Two, longer.</p></article>": "One.\nTwo, longer.",
    "<p>x</p><main><h1>T</h1><article><p>Text.</p></article><p>After.</p></main>": "T\nText.\nAfter.",
    '<main><h1>T</h1><div class="content-sidebar-wrap"><article><p>Text.</p></article></div></main>': "T\nText.",
    '<article class="post category-social"><p>Text.</p></article><div class="comments"><article class="comment"><p>Nice, and long.</p></article></div>': "Text.",
    '<article><p>Text.</p></article><article class="comment-body"><p>Nice, and long.</p></article><form><p>Send</p></form>': "Text.",
    '<div id="w" class="with-sidebar"><article><p>Text.</p></article><div class="related"><article><p>More.</p></article></div></div>': "Text.",
    '<h1>Title</h1><p>A plain page.</p><div class="sidebar"><article>a</article><article>b</article></div>': "Title\nA plain page.",
    "<p>Plain</p><form><p>Send</p></form>": "Plain",
}


@pytest.mark.parametrize("html", LAYOUTS)
def test_layouts(html):
    blocks, _, _ = html_extraction.read_page(page(html))
    assert "\n".join(b["text"] for b in blocks) == LAYOUTS[html]


@pytest.mark.parametrize("small", [20_000, 0])
def test_repeated_nodes_of_a_site_go(spark, monkeypatch, small):
    monkeypatch.setattr(html_extraction, "SMALL_LIST", small)

    def body(i):
        return f"<div class='top'><p>Welcome</p></div><div class='text'><p>Own words {i}</p><p>Again {i * 7}</p></div><div class='end'>Bye</div>"

    rows = [(i, f"http://user@Site.example:80/{i}?q", page(body(i))) for i in range(30)] + [(99, "http://other.example/", page(body(99)))]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[4] == "Own words 4\nAgain 28"
    assert got[99] == "Welcome\nOwn words 99\nAgain 693\nBye"  # one page says nothing about what repeats


def test_importance(spark):
    rows = [("h", "same", 1, [5])] * 4 + [("h", "own", 1, [i]) for i in range(4)] + [("h", "once", 1, [1])]
    tree = {r.path: round(r.importance, 3) for r in style_tree(spark.createDataFrame(rows, "host string, path string, style long, contents array<long>")).collect()}
    assert tree == {"same": 0.0, "own": 0.9, "once": 1.0}


def test_articles_of_a_large_host_stay(spark):
    """20,000 different articles of one host, where few have up to 39 inline tags."""
    rows = spark.range(20_000).selectExpr(
        "id as page_id", "concat('http://big.example/', id) as url",
        "concat('<body><article><p>Own words ', id, repeat(' <b>x</b>', cast(if(id % 1000 < 40, id % 1000, 0) as int)), '</p></article><div>Bye</div></body>') as html",
    )
    got = main_text(rows).selectExpr("count(*)", "count_if(text like concat('Own words ', page_id, '%'))").first()
    assert tuple(got) == (20_000, 20_000)


@pytest.mark.parametrize("url", ["http://copies.example/", None])
def test_copies_of_an_article_keep_their_text(spark, url):
    """30 copies, 30 other articles of the same path, and a note on all pages."""

    def body(i):
        return f"<nav>{i}</nav><article><p>{'One text' if i < 30 else f'Text {i}'}</p><p class='note'>Note</p></article>"

    rows = [(i, url, page(body(i))) for i in range(60)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "One text" if i < 30 else f"Text {i}" for i in range(60)}
    alone = main_text(spark.createDataFrame(rows[:30], "page_id long, url string, html string")).collect()
    assert [r.text for r in alone] == ["One text\nNote"] * 30


def test_own_text_at_a_repeated_path_stays(spark):
    def body(i):
        return f"<article><h1>{i}</h1><p>{'Out of stock' if i < 300 else f'Own text {i}'}</p></article>"

    rows = [(i, "http://h.example/", page(body(i))) for i in range(303)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(299, 303)] == ["299", *(f"{i}\nOwn text {i}" for i in range(300, 303))]


def test_no_pages(spark):
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


ENTRIES = [
    ("bad", "domain", "x.org", "add", day(10)), ("bad", "domain", "x.org", "add", day(15)), ("bad", "domain", "x.org", "remove", day(20)),
    ("bad", "domain", "x.org", "remove", day(30)), ("bad", "domain", "x.org", "add", day(200)),
    ("ads", "prefix", "y.org/a/b", "add", day(0)), ("ads", "prefix", "z.org", "add", day(5)),
    ("allow", "domain", "ok.x.org", "add", day(0)),
    ("flash", "domain", "x.org", "add", day(40)), ("flash", "domain", "x.org", "remove", day(40)),
    (None, "domain", "x.org", "add", day(0)), ("bad", "domain", "y.org", "remove", day(3)), ("bad", "domain", None, "add", day(3)),
]
KINDS = "list string, rule string, pattern string, action string, at timestamp"


def test_validity(spark):
    rows = {(r.list, r.pattern, r.valid_from, r.valid_to) for r in validity(spark.createDataFrame(ENTRIES, KINDS)).collect()}
    assert rows == {
        ("bad", "x.org", day(10), day(20)), ("bad", "x.org", day(200), None), ("ads", "y.org/a/b", day(0), None),
        ("ads", "z.org", day(5), None), ("allow", "ok.x.org", day(0), None),
    }


@pytest.mark.parametrize(
    "url,n,lists,blocked",
    [
        ("http://x.org/", 9, [], False),
        ("http://x.org", 10, ["bad"], True),
        ("http://a.X.ORG:8080/p", 19, ["bad"], True),
        ("http://x.org/", 20, [], False),
        ("http://x.org/", 40, [], False),
        ("http://x.org./", 300, ["bad"], True),
        ("http://ax.org/", 15, [], False),
        ("http://ok.x.org/", 15, ["allow", "bad"], False),
        ("http://y.org/a/b", 1, ["ads"], True),
        ("http://y.org/a/b/c?d#e", 1, ["ads"], True),
        ("http://y.org/a/bc", 1, [], False),
        ("http://z.org/q", 5, ["ads"], True),
        ("http://z.org/q", None, [], False),
        ("not a url", 5, [], False),
        ("", 5, [], False),
        (None, 5, [], False),
    ],
)
def test_url_filter(spark, url, n, lists, blocked):
    captures = spark.createDataFrame([(1, url, None if n is None else day(n), "k")] * 2, "page_id long, url string, fetched timestamp, pattern string")
    got = url_filter(captures, spark.createDataFrame(ENTRIES, KINDS)).collect()
    assert [(r.lists, r.blocked) for r in got] == [(lists, blocked)] * 2


def test_url_parts_and_no_rows(spark):
    df = spark.createDataFrame([("https://u:p@A.b.C:1/x/y/?q#f",), ("ftp://h",)], "u string")
    assert [tuple(r) for r in df.select(host_of(F.col("u")), path_of(F.col("u"))).collect()] == [("a.b.c", "/x/y"), ("h", "")]
    none = spark.createDataFrame([], "page_id long, url string, fetched timestamp")
    assert url_filter(none, spark.createDataFrame(ENTRIES, KINDS)).collect() == []
    one = spark.createDataFrame([(1, "http://x.org", day(1))], "page_id long, url string, fetched timestamp")
    assert [r.blocked for r in url_filter(one, spark.createDataFrame([], KINDS)).collect()] == [False]


def test_loose_text_goes_with_its_branch(spark):
    """Text beside child elements is noise only if the whole element is: what its styles show and all elements below."""

    def body(i):
        other = "<ul><li>x</li></ul>" * (i % 25)  # many styles: the element's presentation is worth much
        return f"<div class='a'>Read<p>Own {i}</p></div><div class='b'>Bye<p>Again</p></div><div class='c'>Also{other}</div>"

    rows = [(i, "http://h.example/", page(body(i))) for i in range(50)]
    got = {r.page_id: r.text.split("\n") for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: ["Read", f"Own {i}", "Also"] for i in range(50)}


def _tree(pages, gamma=0.9):
    """The style tree of parsed pages in plain Python: {path: (pages, importance, highest)}."""
    nodes, below = {}, {}
    for p in pages:
        own = html_extraction.element_nodes(p)
        for path, text, *_ in p.blocks:
            own[path]["contents"].add(text)
        for path, n in own.items():
            nodes.setdefault(path, []).append(n)
            if n["parent"] is not None:
                below.setdefault(n["parent"], set()).add(path)
    out = {}

    def entropy(counts, m):
        return -sum(n / sum(counts) * math.log(n / sum(counts), m) for n in counts)

    def visit(path):
        for child in below.get(path, ()):
            visit(child)
        shown, m = nodes[path], len(nodes[path])
        highest = max((out[c][2] for c in below.get(path, ())), default=0)
        worth = 1.0
        if m > 1:
            styles = Counter(n["style"] for n in shown)
            l = 0 if set(styles) == {None} else len(styles)  # noqa: E741
            contents = Counter(c for n in shown for c in n["contents"])
            text = sum(n * (1 - math.log(n, m)) for n in contents.values()) / max(sum(contents.values()), 1)
            parts = [(n["held"], text) for n in shown] + [(n["share"], out[c][1]) for c in below.get(path, ()) for n in nodes[c]]
            inner = sum(a * b for a, b in parts) / max(sum(a for a, _ in parts), 1e-9)
            worth = (1 - gamma**l) * entropy(styles.values(), m) + gamma**l * inner
        out[path] = (m, worth, max(worth, highest))

    visit(0)
    return out


def test_tree_against_brute_force(spark):
    rng = random.Random(3)

    def some(depth):
        out = ""
        for _ in range(rng.randint(1, 3)):
            kind = rng.choice(["text", "p", "div", "div class=k", "ul"]) if depth else "p"
            text = rng.choice(["Menu", "More", "News", f"own {rng.random()}"])
            out += text + " " if kind == "text" else f"<{kind}>{text if kind == 'p' else some(depth - 1)}</{kind.split(' ')[0]}>"
        return out

    htmls = sorted({page(some(3)) for _ in range(300)})
    nodes = [(int(i), n) for i, h in enumerate(htmls) for n in html_extraction.read_page(h)[1]]
    kinds = "path long, parent long, level int, style long, share double, held double, contents array<long>"
    names = [k.split(" ")[0] for k in kinds.split(", ")]
    df = spark.createDataFrame([("h", i, *(n[k] for k in names)) for i, n in nodes], f"host string, page long, {kinds}")
    got = {r.path: (r.pages, r.importance, r.highest) for r in style_tree(df).collect()}
    want = _tree([Page(h) for h in htmls])
    assert {p for p, w in want.items() if w[0] > 1} <= got.keys() <= want.keys()
    for path, values in got.items():
        assert values == pytest.approx(want[path])
