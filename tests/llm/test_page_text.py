from __future__ import annotations

import pytest

from waitline.llm import page_text


def text(page):
    return " ".join(block for block, _ in page_text.page_blocks(page))


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a<p>b</p>c", "a b c"),
        ("<p>x<b>y</b> z&amp;&eacute;&nbsp;!</p>", "xy z&é !"),
        ("<article><h1>T</h1>in<br>side</article><p>out</p>", "T in side"),
        ("<main>in</main><footer>f</footer>", "in"),
        ("<header>site</header><article><header>T</header>in</article>", "T in"),
        ("<div class='Sidebar left'>s</div><p>in</p>", "in"),
        ("<article>in<section id=comments><article>c</article></section></article>", "in"),
        ("<script>if (a<b) {}</script><style>p{}</style><p>in", "in"),
        ("<!-- <p>no</p> --><!DOCTYPE html><p>in</p><!-- open", "in"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>", "a b 1 2"),
        ("<form>f</form><button>b</button><p hidden>h</p><p style='display: none'>n</p>in", "in"),
        ("<nav><ul><li>menu</nav><p>in</p></div></p>after", "in after"),
        ('<p title="a>b">in</p><a href="x>y', "in y"),
        ("a < b and 3<4", "a < b and 3<4"),
        ("<p>" + "<div>" * 3000 + "deep", "deep"),
        ("<article><p>one</p></article><article><p>two</p></article>", "one two"),
        ("<textarea>no</textarea><title>no</title>in", "in"),
    ],
)
def test_blocks(page, want):
    assert text(page) == want


@pytest.mark.parametrize(
    "page, want",
    [
        ("<div class='layout has-sidebar'><article>in</article><div class=sidebar>s</div></div>", "in"),
        ("<div class='site-content no-sidebar'><main><p>in</p></main></div>", "in"),
        ("<div id='main-menu-page'><p>a long text of the page</p><div class=menu>m</div></div>", "a long text of the page"),
        ("<article class='post with-comments'><p>in</p><div id=comments>c</div></article>", "in"),
        ("<article>in</article><div id=comments><article>c</article></div>", "in"),
        (
            "<div class=has-sidebar><article>the post</article><div id=comments><article>c</article>"
            "</div></div>",
            "the post",
        ),
        ("<div class=no-sidebar><main>in</main></div><div class=related><article>r</article></div>", "in"),
    ],
)
def test_wrappers_with_marks(page, want):
    assert text(page) == want


SCHEMA = "page_id long, url string, html string, text string, host string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "mine", "mine") for r in rows], SCHEMA)


def site(host, count, first=0):
    return [
        (
            first + n,
            f"https://{host}/p/{n}?x=1",
            f"<div class=k1><p>Read {host}</p></div><div><h1>Title {n}</h1><p>Body {n} of {host}.</p>"
            f"<p>Quoted by two: {n // 2}</p></div><div class=k2>About us</div>",
        )
        for n in range(count)
    ]


def test_templates_of_a_site_go(spark):
    rows = site("a.example", 40) + site("b.example", 5, 100)
    got = {
        r.doc.page_id: r.text
        for r in page_text.extracted(pages(spark, rows), keep=["page_id", "url"]).collect()
    }
    assert len(got) == 45
    for n in range(40):
        assert got[n] == f"Title {n} Body {n} of a.example. Quoted by two: {n // 2}"
    # Five pages prove nothing.
    assert got[100] == "Read b.example Title 0 Body 0 of b.example. Quoted by two: 0 About us"


def test_copies_of_a_page_are_no_template(spark):
    page = "<article><p>One text on many pages</p></article>"
    rows = [(n, "https://c.example/x", page) for n in range(60)]
    found = page_text.extracted(pages(spark, rows), keep=["page_id"]).collect()
    assert {r.text for r in found} == {"One text on many pages"} and len(found) == 60


def test_near_copies_of_an_article_keep_their_text(spark):
    """50 copies that differ in a date line or one paragraph, among 100 pages of a host."""
    shared = [f"Paragraph {k} of an article that fifty pages have, long enough to be one." for k in range(6)]

    def page(n):
        if n < 50:
            own = [f"Updated on day {n}", *shared]
            if n % 10 == 0:
                own[3] = f"This paragraph was edited on page {n}."
        else:
            own = [f"Title {n}", *[f"Sentence {k} of page {n} and of no other page at all." for k in range(4)]]
        body = "".join(f"<p>{p}</p>" for p in own)
        return f"<div class=k1><p>Sign up now</p></div><div>{body}</div><div class=k2>About us</div>", own

    rows = [(n, f"https://d.example/{n}", page(n)[0]) for n in range(100)]
    found = page_text.extracted(pages(spark, rows), keep=["page_id"]).collect()
    assert {r.doc.page_id: r.text for r in found} == {n: " ".join(page(n)[1]) for n in range(100)}


def test_boxes_of_a_section_go(spark):
    """A box on a seventh of a large host's pages, and one on very few of them."""
    rows = []
    for n in range(700):
        box = "<div class=k3><p>Our offer of the week</p></div>" if n % 7 == 0 else ""
        rare = "<div class=k4><p>See also our index</p></div>" if n < 9 else ""
        text = f"<div><p>Body of page number {n} and of no other page.</p><p>More on {n}.</p></div>"
        rows.append((n, "https://e.example/", box + rare + text))
    found = page_text.extracted(pages(spark, rows), keep=["page_id"]).collect()
    for r in found:
        start = "See also our index " if r.doc.page_id < 9 else ""
        n = r.doc.page_id
        assert r.text == f"{start}Body of page number {n} and of no other page. More on {n}."


def test_hard_rows(spark):
    rows = [
        (1, None, None), (2, None, ""), (None, "x", "<p>a</p>"), (3, "nonsense", "<p>b</p>"),
        (3, "nonsense", "<p>b</p>"), (4, "http://h/", "<p>" + "w " * 50_000 + "</p>"),
    ]
    found = page_text.extracted(pages(spark, rows), keep=["page_id", "host"]).collect()
    got = sorted((str(r.doc.page_id), len(r.text)) for r in found)
    assert got == sorted([("1", 0), ("2", 0), ("None", 1), ("3", 1), ("3", 1), ("4", 99_999)])
    assert page_text.extracted(pages(spark, []), keep=["page_id"]).count() == 0


def test_query(spark):
    """The articles of the given pages, read off by their tags."""
    import html
    import re

    import __spark_entry__ as registered

    folder = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect()
    want = {}
    for page_id, page in given:
        article = re.search(r"<article>(.*?)(</article>|$)", page, re.DOTALL)
        broken = re.sub(r"</?(?:p|h\d|br|div|li|ul|ol|blockquote)\b[^>]*>", " ", article[1])
        want[page_id] = " ".join(html.unescape(re.sub(r"<[^>]*>", "", broken)).split())
    rows = registered.queries()["op4_page_text"](spark, folder).collect()
    assert {r.page_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)
