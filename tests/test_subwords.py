"""Subword tokens against a search over all prefixes, and windows and labels made of them."""

import random

import pytest
from pyspark.sql import functions as F

from presswork.functions.constants import SENTIMENTS
from presswork.functions.subwords import UNKNOWN, Trie, subword_tokenizer
from presswork.functions.tokens import token_windows
from presswork.operators.labels import label_articles
from presswork.operators.models import Model, rule_weights


def brute(word, pieces):
    found, at = [], 0
    while at < len(word):
        mark = "##" if at else ""
        fits = [n for n in range(1, len(word) - at + 1) if mark + word[at : at + n] in pieces]
        if not fits:
            return [UNKNOWN]
        found.append(mark + word[at : at + max(fits)])
        at += max(fits)
    return found


def test_longest_pieces_as_all_prefixes_give():
    rng = random.Random(8)
    pieces = {"".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(25)}
    pieces |= {"##" + "".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(25)} | {"##", "é", "##日"}
    trie = Trie(pieces)
    words = ["".join(rng.choices("abcd", [5, 5, 5, 1], k=rng.randint(1, 12))) for _ in range(800)] + ["é日日", "日", "é"]
    assert [trie.cut(w) for w in words] == [brute(w, pieces) for w in words]
    assert len(Trie(["a", "##a"]).cut("a" * 200_000)) == 200_000


def test_tokenizer_column(spark):
    vocabulary = spark.createDataFrame([("ab",), ("##c",), ("ab",), (None,), ("",)], "piece string")
    tokenize = subword_tokenizer(vocabulary)
    texts = [None, "", "12", "AB abc\nabd abcc", "ab " * 600]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string").select("k", tokenize(F.col("text")).alias("w"))
    found = {r["k"]: r["w"] for r in rows.collect()}
    assert found == {0: None, 1: [], 2: [], 3: ["ab", "ab", "##c", UNKNOWN, "ab", "##c", "##c"], 4: ["ab"] * 600}
    assert [len(w) for w in rows.where("k = 4").select(token_windows(F.col("w"))).first()[0]] == [512, 88]
    with pytest.raises(ValueError):
        subword_tokenizer(vocabulary, most_bytes=2)


def test_labels_of_subwords_are_those_of_spelled_out_pieces(spark):
    pieces = spark.createDataFrame([("good",), ("bad",), ("##x",), ("##y",)], "piece string")
    weights = rule_weights(pieces.withColumnRenamed("piece", "token"), "sentiment", 1, 3)
    model = Model("sentiment", SENTIMENTS, weights, 1000)
    texts = ["goodx bady", "good", "badxyx goody nothing", "", None, "x"]
    articles = spark.createDataFrame(list(enumerate(texts)), "k int, article string")
    tokenize = subword_tokenizer(pieces)
    for broadcast_bytes in (1 << 20, 0):
        cut = label_articles(articles, [model], ["k"], broadcast_bytes=broadcast_bytes, tokenize=tokenize)
        spelled = lambda text: F.split(F.array_join(tokenize(text), " "), " ")
        plain = label_articles(articles, [model], ["k"], broadcast_bytes=broadcast_bytes, tokenize=spelled)
        assert sorted(map(repr, cut.collect())) == sorted(map(repr, plain.collect()))
    assert {r["k"]: r["sentiment"] for r in cut.collect()}[4] is None
