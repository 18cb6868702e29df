import collections
import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.functions.constants import EMOTIONS, SENTIMENTS
from presswork.operators.labels import _frequent_words, label_articles, label_keys, window_scores
from presswork.operators.models import (
    Model,
    emotion_model,
    fits_broadcast,
    load_model,
    open_model,
    rule_weights,
    save_model,
    sentiment_model,
)
from presswork.operators.predict import WordTable, linear_scorer, open_words, predict_labels, word_keys
from presswork.sources.shared import new_path

VOCABULARY = ["".join(random.Random(i).choices("abcdefgh", k=3)) + "x" * (i % 3) for i in range(150)]


@pytest.fixture(scope="module")
def models(spark):
    root = new_path(spark, "models")
    words = spark.createDataFrame([(w,) for w in sorted(set(VOCABULARY))], "token string")
    for name, labels in (("sentiment", SENTIMENTS), ("emotion", EMOTIONS)):
        save_model(rule_weights(words, name, 1, len(labels)), root, name, 1)
    return [sentiment_model(spark, root), emotion_model(spark, root)]


def brute_label(text, weights, labels):
    if text is None:
        return None
    words = text.lower().split()
    windows = [words[i : i + 512] for i in range(0, max(len(words), 1), 512)]
    names = []
    for window in windows:
        known = [weights[w] for w in window if w in weights]
        scores = [sum(column) for column in zip(*known)]
        names.append(labels[scores.index(max(scores))] if known else "neutral")
    counts = collections.Counter(names)
    return min(counts, key=lambda name: (-counts[name], name))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    sizes = [0, 1, 2, 5, 511, 512, 513, 1024, 1025, 1600, 2600]
    made = [" ".join(rng.choices([*VOCABULARY, "zzz"], k=n)) for n in sizes for _ in range(3)]
    return [*made, None, "zzz zzz", "ZZZ " * 600, "the " * 600 + VOCABULARY[0].upper()]


@pytest.mark.parametrize("broadcast_bytes", [1_000_000, 0])
def test_labels_match_brute_force(spark, models, texts, broadcast_bytes):
    articles = spark.createDataFrame(list(enumerate(texts)), "k int, article string").repartition(3)
    got = {
        r["k"]: (r["sentiment"], r["emotion"])
        for r in label_keys(articles, models, ["k"], "article", broadcast_bytes).collect()
    }
    weights = [{r["token"]: r["w"] for r in m.weights.collect()} for m in models]
    for k, text in enumerate(texts):
        expected = tuple(brute_label(text, w, list(m.labels)) for w, m in zip(weights, models))
        assert got[k] == expected, (k, text and len(text))


def test_pluggable_scorer_gives_the_same(spark, models, texts):
    word = VOCABULARY[0]
    odd = [f"x² {word}½ Ⅷ{word}", "x² x² x²", f"{word}\u0301{word}", "½x abcⅧ", f"{word}_{word} ٣{word}"]
    articles = spark.createDataFrame(list(enumerate(texts + odd)), "k int, article string").repartition(3)
    native = label_articles(articles, models, ["k"])
    arrow = predict_labels(articles, linear_scorer(models), ["sentiment", "emotion"], given=word_keys)
    assert sorted(map(repr, native.collect())) == sorted(map(repr, arrow.collect()))


def test_models_are_measured_together(models):
    sizes = [sum(len(r["token"]) + 64 + 4 * len(m.labels) for r in m.weights.collect()) for m in models]
    assert [m.size for m in models] == sizes
    assert fits_broadcast(models, sum(sizes)) and not fits_broadcast(models, sum(sizes) - 1)


def test_scorer_takes_a_model_of_any_size(spark, models):
    """Above 128 MB by the measure that decides on a broadcast."""
    large = Model("sentiment", SENTIMENTS, models[0].weights, 200 << 20)
    articles = spark.createDataFrame([(1, VOCABULARY[0]), (2, None)], "k int, article string")
    arrow = predict_labels(articles, linear_scorer([large]), ["sentiment"], given=word_keys)
    native = label_articles(articles, [large], ["k"])
    assert sorted(map(repr, arrow.collect())) == sorted(map(repr, native.collect()))


_ON_A_CLUSTER = """
import sys
from pyspark.sql import SparkSession
from presswork.functions.constants import SENTIMENTS
from presswork.operators.models import Model
from presswork.operators.predict import linear_scorer, predict_labels, word_keys

spark = (
    SparkSession.builder.master("local-cluster[2,1,1024]")
    .config("spark.ui.enabled", "false")
    .config("spark.driver.host", "127.0.0.1")
    .config("spark.checkpoint.dir", "file://" + sys.argv[1])
    .getOrCreate()
)
model = Model("sentiment", SENTIMENTS, spark.createDataFrame([("good", [0, 0, 1])], "token string, w array<int>"))
rows = spark.range(40).selectExpr("id", "if(id % 2 = 0, 'good', 'other') AS article").repartition(4)
scored = predict_labels(rows, linear_scorer([model]), ["sentiment"], given=word_keys)
print({(r["id"] % 2, r["sentiment"]) for r in scored.collect()} == {(0, "positive"), (1, "neutral")}, scored.count())
spark.stop()
"""


def test_scorer_on_executors_of_their_own(tmp_path):
    """The driver is no executor here, and Spark refuses to hand out a folder of its machine."""
    repo = Path(__file__).resolve().parent.parent
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_"))} | {"PYTHONPATH": str(repo)}
    command = [sys.executable, "-c", _ON_A_CLUSTER, str(tmp_path / "shared")]
    done = subprocess.run(command, env=env, cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert done.stdout.split() == ["True", "40"], done.stderr[-2000:]


def test_words_are_found_by_both_digests():
    first = np.array([-5, 2, 2, 2, 9])
    table = WordTable(first, np.array([1, 7, 3, 5, 1]), np.zeros((5, 3), np.int32))
    asked = [(-5, 1), (-5, 2), (2, 3), (2, 5), (2, 7), (2, 4), (9, 1), (10, 1), (-9, 1), (3, 1)]
    found = table.places(*(np.array(x) for x in zip(*asked)))
    assert found.tolist() == [0, -1, 2, 3, 1, -1, 4, -1, -1, -1]
    assert WordTable(first[:0], first[:0], np.zeros((0, 3))).places(first, first).tolist() == [-1] * 5


def test_model_is_turned_and_opened_once(spark, models, tmp_path):
    keys = [F.xxhash64("token", F.lit(n)).alias(f"key{n}") for n in (1, 2)]
    rows = models[0].weights.select(*keys, "w")
    folder = str(tmp_path / "model")
    rows.repartitionByRange(3, "key1").sortWithinPartitions("key1").write.parquet(folder)
    (tmp_path / "model.first.part").write_bytes(b"left by a process that was ended")
    table = open_words(folder, 3)
    assert open_words(folder, 3) is table and isinstance(table.weights, np.memmap)
    assert len(table.first) == rows.count() and (np.diff(table.first) >= 0).all()
    stored = {(r["key1"], r["key2"]): r["w"] for r in rows.collect()}
    assert all(stored[int(a), int(b)] == list(w) for a, b, w in zip(table.first, table.second, table.weights))


def test_models_that_outgrow_a_machine_are_refused(models):
    with pytest.raises(ValueError, match="outgrow"):
        linear_scorer(models, most_bytes=10)


def test_rows_are_neither_multiplied_nor_lost(spark, models):
    word = VOCABULARY[0]
    rows = [("u", 1, word), ("u", 1, word), ("u", 1, VOCABULARY[1]), (None, 1, word), ("v", None, None), ("v", 1, "")]
    articles = spark.createDataFrame(rows, "id string, batch int, article string")
    labelled = label_articles(articles, models).collect()
    assert sorted(map(repr, [r[:3] for r in map(tuple, labelled)])) == sorted(map(repr, rows))
    by_text = collections.defaultdict(set)
    for r in labelled:
        by_text[r["article"]].add((r["sentiment"], r["emotion"]))
    assert by_text[None] == {(None, None)} and by_text[""] == {("neutral", "neutral")}
    assert len(by_text[word]) == 1


def test_score_ties_take_the_lowest_class(spark):
    weights = spark.createDataFrame([("a", [0, 5, 5]), ("b", [-1, -1, -1])], "token string, w array<int>")
    model = Model("sentiment", SENTIMENTS, weights)
    articles = spark.createDataFrame([(1, "a"), (2, "b")], "k int, article string")
    labels = {r["k"]: r["sentiment"] for r in label_keys(articles, [model], ["k"]).collect()}
    assert labels == {1: "neutral", 2: "negative"}
    scores = window_scores(articles, [model], ["k"]).orderBy("k").collect()
    assert [r["scores_sentiment"] for r in scores] == [[0, 5, 5], [-1, -1, -1]]


def test_hot_word_and_long_article_with_salted_join(spark):
    weights = spark.createDataFrame([("hot", [1, 0, 0]), ("cold", [0, 0, 9])], "token string, w array<int>")
    model = Model("sentiment", SENTIMENTS, weights)
    articles = spark.range(300).select(
        F.col("id").alias("k"),
        F.when(F.col("id") == 0, F.repeat(F.lit("hot "), 20_000)).otherwise(F.lit("hot cold hot")).alias("article"),
    )
    labels = label_keys(articles, [model], ["k"], broadcast_bytes=0).groupBy("sentiment").count().collect()
    assert {r["sentiment"]: r["count"] for r in labels} == {"negative": 1, "positive": 299}


def test_large_models_shuffle_rare_words_only(spark, models, texts):
    """Frequent words meet their weights in place; what is frequent changes no score."""
    articles = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] * 2, "k int, article string").repartition(3)

    def plain(scores):
        rows = [(r["k"], r["window"], tuple(r["scores_sentiment"]), tuple(r["scores_emotion"])) for r in scores.collect()]
        return sorted(rows)

    expected = plain(window_scores(articles, models, ["k"]))
    for most in (0, 20_000, 1 << 20):
        assert plain(window_scores(articles, models, ["k"], broadcast_bytes=0, frequent_bytes=most)) == expected


def test_frequent_words_fit_their_bytes(spark):
    weights = spark.createDataFrame([(w, [1, 2, 3]) for w in ("a", "b", "c", "e")], "token string, w array<int>")
    model = Model("sentiment", SENTIMENTS, weights)
    words = spark.createDataFrame([(w,) for w in "a" * 9 + "b" * 5 + "d" * 5 + "c"] + [(None,)], "token string")
    size = 1 + 64 + 4 * 3
    got = lambda most: {(r["token"], r["w_sentiment"] is not None) for r in _frequent_words(words, [model], most).collect()}
    assert got(size - 1) == set() and got(3 * size - 1) == {("a", True)}
    # An unknown word is listed too, so that it need not move.
    assert got(3 * size) == {("a", True), ("b", True), ("d", False)}
    hot = words.unionByName(spark.range(3000).selectExpr("'x' AS token"))
    assert {r["token"] for r in _frequent_words(hot, [model], 0).collect()} == {"x"}


def test_model_versions(spark):
    root = new_path(spark, "versions")
    words = spark.createDataFrame([("a",), ("b",)], "token string")
    for version in (1, 2, 10):
        save_model(rule_weights(words, "m", version, 3), root, "m", version)
    save_model(rule_weights(words, "other", 99, 3), root, "other", 99)
    one = {r["token"]: r["w"] for r in load_model(spark, root, "m", 1).collect()}
    newest = load_model(spark, root, "m")
    assert {r["version"] for r in newest.collect()} == {10}
    assert {r["token"]: r["w"] for r in newest.collect()} != one
    save_model(words.where("token = 'a'").withColumn("w", F.array(F.lit(7))), root, "m", 10)
    assert [(r["token"], r["w"]) for r in load_model(spark, root, "m").collect()] == [("a", [7])]
    assert load_model(spark, root, "m", 2).count() == 2
    assert load_model(spark, root, "m", 3).count() == 0
    assert open_model(spark, root, "m", ["x"]).weights.first()["version"] == 10
    assert open_model(spark, root, "m", ["x"], 2).size == 2 * 69
    with pytest.raises(ValueError):
        open_model(spark, root, "m", ["x"], 3)
    assert all(-3 <= w <= 3 for ws in one.values() for w in ws)
