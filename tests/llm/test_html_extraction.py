"""Main texts against a plain reading of planted and of given pages."""

import html
import re

import pytest

from clicktide.llm import html_extraction as he, queries
from tests.llm.helpers import SF, needs_data, rows_of

PAGES = "page_id long, url string, html string"


def pages_of(spark, pages):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], PAGES)


def texts_of(frame):
    return {r["page_id"]: r["text"] for r in rows_of(he.extract_main_text(frame))}


def lorem(seed, words=40):
    return " ".join(f"w{seed}x{i}" for i in range(words))


def soup_page(i, paragraphs):
    """No article element: the text is in a nameless div among menus and notices."""
    body = "".join(f"<p>{lorem(f'{i}_{k}')}" for k in range(paragraphs))
    return (
        f"<html><body class='with-sidebar'><div class=header>My site</div><div><a href=/>Home</a> <a href=/x>All</a></div>"
        f"<div><h2>Title {i}</h2>{body}<div class='cookie-notice'>We use cookies</div></div>"
        f"<div id=comments><p>{lorem('c', 200)}</p></div><div>Same line on every page</div>"
        f"<form><p>{lorem('f', 90)}</p></form><script>if (a < b) document.write('</p>')</script></body></html>"
    )


def test_wrapper_without_article_element(spark):
    pages = [("http://soup.example/%d" % i, soup_page(i, 2 + i % 3)) for i in range(9)]
    got = texts_of(pages_of(spark, pages))
    for i in range(9):
        blocks = [f"Title {i}", *(lorem(f"{i}_{k}") for k in range(2 + i % 3))]
        assert got[i] == "\n\n".join(blocks)


def entry_page(i, own):
    """The text stands below an element whose class only copies of this page have."""
    return (
        f"<html><body><div>Same line on every page</div><div class='entry post-{i}'><h2>Title {own}</h2>"
        f"<p>{lorem(f'{own}a')}<p>{lorem(f'{own}b')}</div></body></html>"
    )


@pytest.mark.parametrize("copies", [3, 1000])
def test_copies_of_a_page_keep_their_text(spark, copies):
    copied = [("http://copies.example/%d" % i, soup_page(0, 2)) for i in range(copies)]
    mixed = [("http://mixed.example/%d" % i, entry_page(i, i)) for i in range(9)]
    mixed += [("http://mixed.example/%d" % i, entry_page(812, "copy")) for i in range(copies)]
    got = texts_of(pages_of(spark, copied + mixed).repartition(4))
    alone = {got[i] for i in range(copies)}
    assert len(alone) == 1 and "\n\n".join(["Title 0", lorem("0_0"), lorem("0_1")]) in alone.pop()
    for i, own in enumerate([*range(9), *["copy"] * copies], copies):
        assert got[i] == "\n\n".join([f"Title {own}", lorem(f"{own}a"), lorem(f"{own}b")])


def test_pages_with_nothing_but_the_template_keep_their_text(spark):
    pages = [("http://t.example/%d" % i, f"<nav>{i}</nav><div><p>{lorem('t')}</div>") for i in range(5)]
    assert set(texts_of(pages_of(spark, pages)).values()) == {lorem("t")}


def test_parts_of_a_page_that_are_not_the_article(spark):
    page = (
        "<title>T</title><header><h1>Site</h1></header><nav>menu</nav><main><aside>side</aside><article>"
        "<header><h1>Head &amp; line</h1></header><p>One <b>bold</b>\n word&nbsp;&#39;x&#x27;</p><div class='ad-box'>buy</div>"
        "<ul><li>a<li>b</ul><p hidden>no</p><style>p{}</style><!-- <p>no</p> -->a &lt; b<br>c"
        "<table><tr><td>1<td>2</table><section class='user-comments'><p>nice</p></section></article></main>"
        "<div role=dialog>d</div><footer>f</footer>"
    )
    got = texts_of(pages_of(spark, [("https://x.example/1", page)]))
    assert got[0] == "\n\n".join(["Head & line", "One bold word 'x'", "a", "b", "a < b c", "1", "2"])


def test_alignment_finds_optional_and_repeated_groups():
    def wrapper(*pages):
        one = None
        for page in pages:
            one = he.align(one, he.wrapper_of(he.parse(page)))
        return he.expression(one)

    assert wrapper("<p>a</p>", "<p>a</p>") == "<html><p>a</p></html>"
    assert wrapper("<p>a</p>", "<p>b</p>") == "<html><p>#</p></html>"
    assert wrapper("<p>a</p>", "<p>a</p><p>b</p>") == "<html>(<p>#</p>)+</html>"
    assert wrapper("<h1>t</h1><p>a</p>", "<p>a</p>") == "<html>(<h1>t</h1>)?<p>a</p></html>"
    many = ["<h2>t</h2><p>a</p>" * n for n in (1, 3, 2)]
    assert wrapper(*many) == "<html>((<h2>t</h2>)+? (<p>a</p>)+?)+</html>"
    assert wrapper(*reversed(many)) == "<html>((<h2>t</h2>)+? (<p>a</p>)+?)+</html>"


def test_wrapper_size_does_not_grow_with_pages():
    one = None
    for i in range(300):
        pieces = ["<h2>x</h2>", "<p>y</p>", "<ul><li>z</ul>", "<ul><li>a<li>b<p>c</ul>", "text <hr>"]
        body = "".join(pieces[(i * k + k // 3) % 5] for k in range(i % 40))
        one = he.align(one, he.wrapper_of(he.parse(f"<article>{body}</article>")))
    assert len(he.expression(one)) < 600


def classed_page(i):
    """Every page has classes of its own, and parts that no list of names knows."""
    return (
        f"<html><body class='page-{i}'><div class='zone-top q{i}'>Welcome to the Daily Wombat</div>"
        f"<div class='entry post-{i} hue-{i % 7}'><h2>Title {i}</h2><p class='k{i}'>{lorem(f'{i}a')}"
        f"<div class='xq9'>Readers like you keep this place running. Chip in today!</div>"
        f"<p class='k{i}'>{lorem(f'{i}b')}<div class='plug-{i}'>Buy the Wombat mug while stocks last, now half price</div></div>"
        f"<div class='foot'>All rights reserved</div></body></html>"
    )


def host_wrapper(pages):
    one = None
    for page in pages:
        one = he.align(one, he.wrapper_of(he.parse(page)))
    return he.finished(one)


def test_classes_of_pages_do_not_grow_the_wrapper():
    sizes = {n: len(he.expression(host_wrapper(map(classed_page, range(n))))) for n in (100, 400, 1600)}
    assert max(sizes.values()) < 600 and max(sizes.values()) - min(sizes.values()) < 20


def test_host_wrapper_is_right_where_a_page_alone_is_not(spark):
    pages = [classed_page(i) for i in range(60)]
    host = host_wrapper(pages)
    for i, page in enumerate(pages):
        expected = "\n\n".join([f"Title {i}", lorem(f"{i}a"), lorem(f"{i}b")])
        alone = he.extract(he.parse(page), he.wrapper_of(he.parse(page)))
        assert he.extract(he.parse(page), host) == expected
        assert "Chip in" in alone and "mug" in alone
    rows = [(f"http://wombat.example/{i}", page) for i, page in enumerate(pages)]
    got = texts_of(pages_of(spark, rows).repartition(7))
    assert got == {i: "\n\n".join([f"Title {i}", lorem(f"{i}a"), lorem(f"{i}b")]) for i in range(60)}


@pytest.mark.parametrize("pages, dropped", [(9, False), (10, True), (40, True)])
def test_template_texts_in_marked_articles(pages, dropped):
    made = [
        f"<article><h1>Title {i}</h1><p>{lorem(i)}<div class='xq9'>Chip in today!</div><p>{lorem(i + 900)}</article>"
        for i in range(pages)
    ]
    host = host_wrapper(made * 3)  # copies count once
    for i, page in enumerate(made):
        texts = [f"Title {i}", lorem(i), *([] if dropped else ["Chip in today!"]), lorem(i + 900)]
        assert he.extract(he.parse(page), host) == "\n\n".join(texts)


def test_few_classes_stay_apart():
    pages = [f"<div class=top>a{i}</div><div class=story>b{i}</div><div class=end>c{i}</div>" for i in range(50)]
    assert he.expression(host_wrapper(pages)) == "<html><div.top>#</div><div.story>#</div><div.end>#</div></html>"


def test_tree_of_tasks_gives_the_same_texts(spark, monkeypatch):
    monkeypatch.setattr(he, "FAN_IN", 2)
    pages = [("http://soup.example/%d" % i, soup_page(i, 2 + i % 3)) for i in range(12)]
    one = texts_of(pages_of(spark, pages).coalesce(1))
    assert texts_of(pages_of(spark, pages).repartition(5)) == one


@pytest.mark.parametrize("broken", ["<", "<p", "<p class='x", "<!-- x", "<script>x", "</p></p>", "<p>a</div></p>b<td>",
                                    "a<b>c", "&#xFFFFFFFF;&nope;&", "<li><li><ul><li>", "<table><p>x<tr>y",
                                    "<div>x" * 5000, "<ul><li>x" * 3000])
def test_broken_pages_are_read(broken):
    he.extract(he.parse(broken), he.wrapper_of(he.parse(broken)))


@pytest.mark.parametrize("before", [0, 59, 63, 70])
@pytest.mark.parametrize("inside", [0, 1, 6, 65, 300])
def test_deep_elements_are_read_in_their_places(spark, before, inside):
    body = (
        "<h1>Title</h1>" + "<div>" * inside + "<p>deep<blockquote>quoted<nav><div><p>menu</div>more menu</nav>still quoted"
        "<header><p>head</header></blockquote>after<aside>aside<div>x</div>aside</aside><ul><li>a<li>b</ul>"
        "<table><tr><td>1<td>2</table>" + "</div>" * inside + "<p>last"
    )
    page = f"<body><div>outside</div>{'<div>' * before}<nav>n</nav><article>{body}</article>out{'</div>' * before}<p>end</p></body>"
    expected = ["Title", "deep", "quoted", "still quoted", "head", "after", "a", "b", "1", "2", "last"]
    assert he.extract(he.parse(page), he.wrapper_of(he.parse(page))) == "\n\n".join(expected)
    plain = page.replace("article>", "section>")
    found = he.extract(he.parse(plain), he.wrapper_of(he.parse(plain))).split("\n\n")
    assert set(expected[1:-1]) - {"head"} <= set(found) and not {"menu", "more menu", "aside", "x", "n", "head"} & set(found)


def test_tree_of_a_deep_page_on_many_pages(spark):
    deep = [f"<div>{'<div>' * 70}<nav>menu</nav><article><p>{lorem(i)}<div>{lorem(i + 100)}</div>" for i in range(5)]
    pages = [(f"http://deep.example/{i}", f"{page}</article>{'</div>' * 71}<p>foot") for i, page in enumerate(deep)]
    got = texts_of(pages_of(spark, pages).repartition(3))
    assert got == {i: f"{lorem(i)}\n\n{lorem(i + 100)}" for i in range(5)}


def test_awkward_rows(spark):
    rows = [(1, "http://a.b/c", None, "x"), (2, None, "<p>some text</p>", "x"), (3, "http://a.b/c", "", None),
            (None, "::", "<article><p>no id</p></article>", "x"), (4, "http://a.b/d", "<p>" + "word " * 300_000, "x"),
            (5, "http://q/1", "<p>twice</p>", "x"), (5, "http://q/1", "<p>twice</p>", "x")]
    frame = spark.createDataFrame(rows, f"{PAGES}, host string")
    for name in ("of_host", "wrapper", "text", "key", "place"):
        frame = frame.withColumn(name, frame["host"])
    got = [(r["page_id"], r["text"]) for r in rows_of(he.extract_main_text(frame))]
    assert len(got) == 7 and (1, "") in got and (3, "") in got and (2, "some text") in got
    assert (None, "no id") in got and got.count((5, "twice")) == 2
    assert (4, ("word " * 300_000).strip()) in got
    assert he.extract_main_text(frame.limit(0)).collect() == []


@needs_data
def test_whole_table(spark):
    def plain(page):
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
        blocks = re.split(r"</?(?:p|h1)>", article[1]) if article else []
        blocks = [" ".join(html.unescape(re.sub(r"<[a-z/][^>]*>", " ", b)).split()) for b in blocks]
        return "\n\n".join(b for b in blocks if b)

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = rows_of(queries.op6_html_extraction(spark, SF))
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == plain(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])
