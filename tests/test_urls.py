import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from presswork.functions.urls import article_key, find_urls, remove_urls

# Fixed value: the URL shape in its usual backtracking form, the reference for results.
BRUTE = re.compile(
    r"""(?i)\b((?:[a-z][\w-]+:(?:/{1,3}|[a-z0-9%])|www\d{0,3}[.]|[a-z0-9.\-]+[.][a-z]{2,4}/)(?:[^\s()<>]+|\(([^\s()<>]+|(\([^\s()<>]+\)))*\))+(?:\(([^\s()<>]+|(\([^\s()<>]+\)))*\)|[^\s`!()\[\]{};:'".,<>?«»“”‘’]))"""
)


def brute_find(text):
    return [m.group(1) for m in BRUTE.finditer(text)]


def brute_remove(text):
    for url in brute_find(text):
        text = text.replace(url, "")
    return text


def run(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = frame.select("i", find_urls(F.col("t")).alias("f"), remove_urls(F.col("t")).alias("r"))
    return [(row.f, row.r) for row in rows.orderBy("i").collect()]


CASES = [
    "",
    "no link here. None, at all!",
    "see http://a.com and http://a.com/b",
    "http://a.com/b then http://a.com",
    "end http://a.com. Next",
    'quoted "http://a.com/x", and (http://b.org/y)',
    "nested http://a.com/x_(y(z))_w end",
    "unclosed http://a.com/x_(y(z end",
    "http://a.com/((((((((",
    "http://a.com/()",
    "http://a.com/(())",
    "update:new and a:b and ab:c and ab:cd",
    "www.a and www2.example.com/x, www1234.no WWW.UP.COM",
    "example.com/a example.com/ab x.toolong/abc a.b.co/12",
    "HTTP://UPPER.COM/PATH",
    "no break http://a.com/ x",
    "é.com/abc éa.com/abc _a.com/abc é.x.com/abc",
    "ünï:codé http://exämple.de/straße",
    "http:// http:/// http://// http:/a http:/ab",
    "http://!!!!!! http://a!!!!!!b",
    "mailto:me@x.org tel:%20 a-b-c:d-e",
    "<http://a.com/b>c http://a.com/b<c",
    "line\nhttp://a.com/x\tftp://b.org/y",
    "aahttp://x.yy/zhttp://x.yy/z twice",
    "“http://a.com/x” «http://a.com/y»",
    "x.y.zz/ab(c)d.(e).f",
    "😀http://a.com/😀 😀",
]


def test_cases(spark):
    for text, (found, rest) in zip(CASES, run(spark, CASES)):
        assert found == brute_find(text), text
        assert rest == brute_remove(text), text


def test_random_texts_match_brute_force(spark):
    rng = random.Random(7)
    parts = [
        "http:", "/", "//", "www", ".", "-", "_", "a", "b", "com", "x1", ":", "(", ")", "()", " ", "<",
        ">", "!", ",", "é", " ", "?", "'", "%", "9", "W", "\n", "“",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(20_000)]
    for text, (found, rest) in zip(texts, run(spark, texts)):
        assert found == brute_find(text), repr(text)
        assert rest == brute_remove(text), repr(text)


@pytest.mark.parametrize(
    "text",
    [
        "http://a.com/" + "x" * 1_000_000,
        "http://a.com/" + "(" * 100_000,
        "http://a.com/" + "(a)" * 100_000,
        "http://a.com/(" + "(a)" * 100_000,
        "http://a.com" + "!" * 200_000,
        "http://a.com/" + "x!" * 100_000,
        "a " * 500_000,
        "a-" * 200_000 + ":",
        "a_-" * 200_000 + ":",
        "a.-" * 200_000 + "/:",
        "1-_é" * 200_000 + ":",
        "www." * 200_000,
        "ab:(" * 200_000,
        "ab:!" * 200_000,
    ],
)
def test_long_texts_end_soon(spark, text):
    start = time.time()
    [(found, rest)] = run(spark, [text])
    assert time.time() - start < 30
    assert found == [] or all(text.find(url) >= 0 for url in found)
    assert rest == text if not found else len(rest) < len(text)


def test_null_stays_null(spark):
    assert run(spark, [None, "http://a.com/x"])[0] == (None, None)


def test_article_key_is_md5_of_url(spark):
    [row] = spark.createDataFrame([("http://a.com",)], "u string").select(article_key(F.col("u"))).collect()
    assert row[0] == hashlib.md5(b"http://a.com").hexdigest()
