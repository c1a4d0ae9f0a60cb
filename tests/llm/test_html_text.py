import html
import re
import time

import pytest

from tidegate.llm.html_text import Page, extract_text, main_blocks, main_text, path_scores

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="home"><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">Menu entry</a></li></ul></nav><div class="cookie-notice">We use cookies, all of them, to follow you.</div>
<div class="content"><h2>Title</h2><p>First&nbsp;para with <b>bo</b>ld &eacute; text, long enough.<p>Second <a href="y">linked</a> one.<br>after
<aside>Side note, which is of great length.</aside></div><section id="comments"><p>Reader's comment, long, with commas, too.</p></section>
<form><label>Name</label></form><footer>&copy; me</footer><script>if(a<b)x="</p>"</script></body></html>"""


def test_parts_around_the_article_go():
    assert main_text(PAGE) == "Title First para with bold é text, long enough. Second linked one. after"


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a<p", "a"), ("<p>a &amp", "a &"), ("<p>a &am", "a &am"),
    ("<nav>only a menu</nav>", ""), ("<p>x</p><p>y</p>", "x y"), ("<p>x<i>y</i>z</p>", "xyz"), ("<!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<script>never closed", ""), ("<p title='a>b'>c</p>", "c"), ('<p><a href="x>foo</a> bar', "foo bar"), ("<p>1 < 2</p>", "1 < 2"),
])
def test_odd_pages(source, text):
    assert main_text(source) == text


def test_generated_pages_give_the_article(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    for row in extract_text(pages).select("page_id", "html", "main.*").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", row.html, re.S)[1]
        blocks = re.sub(r"<(?:br|/?p|/?h1)>", " ", article)
        assert row.text == " ".join(html.unescape(re.sub(r"<[^>]*(>|$)", "", blocks)).split())
        assert row.n_chars == len(row.text)


def test_paths_outside_content_have_no_score():
    page = Page(PAGE)

    def path(number):
        return [] if number < 1 else [*path(page.parents[number]), page.labels[number].split()[0]]

    scores = path_scores(page)
    assert all(s == 0 for n, s in enumerate(scores) if {"nav", "footer", "aside", "header"} & set(path(n)))
    assert len({*scores}) > 3


def test_ratios_alone_find_most_articles():
    import pyarrow.parquet as pq

    pages = [p["html"] for p in pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist() if p["html"]]
    same = sum(" ".join(main_blocks(h, names=False)) == main_text(h) for h in pages)
    assert same >= 0.9 * len(pages), f"{same} of {len(pages)}"


@pytest.mark.parametrize("source, text", [
    ("<article><p title=it's>one one</p><p>two two</p><p>it's three</p></article>", "one one two two it's three"),
    ("<article><div class='post-header'>By me, today</div><p class='share-price note'>Price, 3.</p><p>Text, of the rest.</p></article>", "By me, today Price, 3. Text, of the rest."),
    ("<article><p>Text, of the article, which is long.</p><div class='comments'><p>Me too!</p></div></article>", "Text, of the article, which is long."),
    ("<div class=\"a'b\"><p>It is, as it is.</p></div>", "It is, as it is."), ("<p a==\"x>y\">z</p>", 'y\">z'),
    ("<table><tr><td>a, b.<td>c, d.<tr><td><p>e, f.</table>", "a, b. c, d. e, f."), ("<ul><li>one, a.<li>two, b.</ul>", "one, a. two, b."),
])
def test_quotes_classes_and_implied_ends(source, text):
    assert main_text(source) == text


@pytest.mark.parametrize("source", [
    "<div>word " * 100_000, "<b>word " * 100_000, "<b><p>word " * 50_000, "".join(f"<section class='{chr(97 + i % 26)}{'x' * (i // 26)}'>" * (i < 400) + f"<div class=c{i}>word, word.</div>" for i in range(5_000)),
    "".join(f"<p class='{'ab'[i % 2] * (1 + i % 317)} {'cd'[i % 2] * (1 + i // 317)}'>word, word.</p>" for i in range(30_000)), "</i>" * 200_000, "<td><table>" * 30_000,
])
def test_deep_and_wide_pages_take_linear_time(source):
    started = time.process_time()
    main_text(source)
    assert time.process_time() - started < 20


def test_long_and_repeated_pages_and_other_columns(spark):
    long = "<article>" + "<p>word word, word.</p>" * 20_000 + "</article>"
    df = spark.createDataFrame([(1, long, "x"), (1, long, "x"), (None, None, None)], "page_id bigint, html string, text string")
    rows = extract_text(df).collect()
    assert [r.text for r in rows] == ["x", "x", None]
    assert rows[0].main == rows[1].main and rows[0].main.n_chars == 20_000 * 17 - 1
    assert extract_text(df.limit(0)).count() == 0
