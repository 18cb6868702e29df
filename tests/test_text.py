import time

import pytest
from pyspark.sql import functions as F

from presswork.functions.html import page_text, page_title
from presswork.functions.scores import argmax, elected, label_of
from presswork.functions.tokens import head_tokens, token_windows, tokens, window_count


def one(spark, value, *columns):
    [row] = spark.createDataFrame([(value,)], "v string").select(*columns).collect()
    return tuple(row)


@pytest.mark.parametrize(
    "html, title, text",
    [
        ("<title>A</title><article><p>b</p></article>", "A", "b"),
        ("<TITLE lang=x>A\n  B</TITLE><ARTICLE class=y>b</ARTICLE>", "A B", "b"),
        ("<title></title><article>b</article>", "", "b"),
        ("<title>A</title><body class=x><p>b</p></body>", "A", "b"),
        ("<title>A</title><p>b</p>", "A", "b"),
        ("<article>a<article>b</article>c</article>d<article>e</article>f", "", "a\n\nb\n\nc\n\ne"),
        ("<article>a", "", "a"),
        ("<article-nav>menu</article-nav><article\nid=1>b</article>", "", "b"),
        ("<titles>x</titles><title>A</title><scripts>y</scripts><article>b<scripted>c</scripted></article>", "A", "bc"),
        ("<article>it&#8217;s &#x27;q&#x27; &eacute;&hearts;&nope;&#0; &#38;lt; &#1114112;&amp;amp;</article>", "", "it’s 'q' é♥&nope;\ufffd &lt; \ufffd&amp;"),
        ("<article>a &amp;lt; b &lt; c&nbsp;d</article>", "", "a &lt; b < c d"),
        ("<article><p>a<b>b</b><br>c<p>d</article>", "", "ab\n\nc\n\nd"),
        ("<article>a<script>var t='</p>'</script>b<!-- c -->d<style>p{}</style></article>", "", "abd"),
        ("<title>one</title><title>two</title>", "one", ""),
        ("", "", ""),
        (None, None, None),
    ],
)
def test_page_extraction(spark, html, title, text):
    assert one(spark, html, page_title(F.col("v")), page_text(F.col("v"))) == (title, text)


@pytest.mark.parametrize(
    "html, title, text",
    [
        ("<title>A<title>B</title><article>c</article>", "AB", "c"),
        ("<title>a < b</title>c", "a < b", "c"),
        ("<title>A<p>b", "A", "A\n\nb"),
        ("<title>A</title>b<script>c<p>d", "A", "b"),
        ("a<!-- b <article>c</article>", "", "a"),
        ("<article>a < b > c <x</article>", "", "a c <x"),
        ("a & b &amp;&amp;amp; &&lt;", "", "a & b &&amp; &<"),
        ("</article>a<article>b</article></article>c<article>d", "", "b\n\nd"),
    ],
)
def test_broken_pages(spark, html, title, text):
    assert one(spark, html, page_title(F.col("v")), page_text(F.col("v"))) == (title, text)


@pytest.mark.parametrize(
    "unit",
    ["<", "<title>", "<title ", "<script>", "<script ", "</script ", "<!--", "<style><title>", "<article>", "<article ",
     "</article>", "<article>x</article>", "<body>", "<p", "<p>", "&", "&#", "&lt;", "&#60;", " ", " \n", "<title><", "</title>"],
)
def test_pages_of_a_megabyte_take_seconds(spark, unit):
    """Every page below took minutes or more with patterns that search to its end from each start."""
    page = unit * (1_000_000 // len(unit))
    start = time.monotonic()
    one(spark, page, F.length(page_title(F.col("v"))), F.length(page_text(F.col("v"))))
    assert time.monotonic() - start < 15


def test_many_articles_are_put_together_whole(spark):
    page = "".join(f"<article>a{i}<article>b{i}</article>c{i}</article>d" for i in range(50_000))
    [text] = one(spark, page, page_text(F.col("v")))
    assert text.split() == [f"{x}{i}" for i in range(50_000) for x in "abc"]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 1024, 1025])
def test_windows_cut_all_words(spark, n):
    words = tokens(F.col("v"))
    got = one(spark, "Word " * n, token_windows(words), window_count(words), F.size(head_tokens(F.col("v"))))
    windows, count, head = got
    assert len(windows) == count == max(n - 1, 0) // 512 + 1
    assert [w for window in windows for w in window] == ["word"] * n
    assert all(len(window) == 512 for window in windows[:-1])
    assert head == min(n, 512)


def test_tokens_are_lower_case_letters_of_any_script(spark):
    assert one(spark, "Él 3x don't ÜBER_a", tokens(F.col("v")))[0] == ["él", "x", "don", "t", "über", "a"]


def test_argmax_and_vote_ties(spark):
    frame = spark.createDataFrame([([1, 3, 3],), ([0, 0, 0],)], "s array<bigint>")
    labels = ["b", "c", "a"]
    rows = frame.select(argmax(F.col("s")), label_of(argmax(F.col("s")), labels), elected(F.col("s"), labels))
    # Votes are in name order: a has 1, b and c have 3 each.
    assert [tuple(r) for r in rows.collect()] == [(1, "c", "b"), (0, "b", None)]
