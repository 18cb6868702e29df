"""Scoring as joins and sums: words x weights -> window scores -> window labels -> article label."""

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.constants import NEUTRAL, WINDOW_TOKENS
from presswork.functions.numbers import int_div
from presswork.functions.scores import argmax, class_sums, elected, label_of, label_votes
from presswork.functions.tokens import tokens
from presswork.operators.models import BROADCAST_BYTES, Model, fits_broadcast
from presswork.sources.shared import materialize

# A word is hot with more than this share of all words; there are at most as many hot words as shares.
HOT_SHARES = 1000
# Most frequent words of larger models, with their weights, that are sent to every executor.
FREQUENT_BYTES = 64 * 1024 * 1024


def window_words(
    articles: DataFrame, key: Sequence[str], text: str, tokenize: Callable[[Column], Column] = tokens
) -> DataFrame:
    """One row per word of the whole text: key, window, token. A text without words gives one row
    with a null token. `has_text` is false for null texts. Words are what `tokenize` makes of a text."""
    words = tokenize(F.col(text))
    listed = articles.select(*key, F.col(text).isNotNull().alias("has_text"), words.alias("words"))
    placed = listed.select(*key, "has_text", F.posexplode_outer("words").alias("at", "token"))
    window = int_div(F.coalesce("at", F.lit(0)), WINDOW_TOKENS).cast("int")
    return placed.select(*key, "has_text", window.alias("window"), "token")


def _weights(model: Model) -> DataFrame:
    return model.weights.select("token", F.col("w").alias(f"w_{model.name}"))


def _frequent_words(words: DataFrame, models: Sequence[Model], most_bytes: int) -> DataFrame:
    """The words that occur most, as many as measure at most `most_bytes` with their weights, and every hot word.

    Words are counted over the whole input, within each task before they are shuffled. Counts are told apart by
    powers of the eighth root of two: a table has a few hundred.
    """
    counted = words.where(F.col("token").isNotNull()).groupBy("token").agg(F.count(F.lit(1)).alias("_n"))
    counted = materialize(counted, "word-counts")
    step = F.floor(F.log2("_n") * 8).cast("int")
    size = F.sum(F.octet_length("token") + (64 + 4 * sum(len(m.labels) for m in models)))
    steps = counted.groupBy(step.alias("step")).agg(size.alias("bytes"), F.sum("_n").alias("rows")).collect()
    chosen, left = F.lit(False), most_bytes
    for row in sorted(steps, reverse=True):
        left -= row["bytes"]
        if left < 0:
            break
        chosen = step >= row["step"]
    # At most HOT_SHARES words, whatever the input.
    share = max(1000, sum(row["rows"] for row in steps) // HOT_SHARES)
    listed = counted.where(chosen | (F.col("_n") > share)).select("token")
    found = listed
    for model in models:
        known = _weights(model).join(F.broadcast(listed), "token", "left_semi")
        found = found.join(known, "token", "left")
    return materialize(found, "frequent-words")


def _weigh_by_shuffle(words: DataFrame, models: Sequence[Model], frequent_bytes: int) -> DataFrame:
    """Words with their weights: frequent ones in their place, by a broadcast, the others by a sorted merge join.

    Every word has a row, with weights if it is frequent. One that is not has a second row, with its weights, from the
    join if a model knows it. These are few and none of them is hot.
    """
    frequent = _frequent_words(words, models, frequent_bytes)
    placed = words.join(F.broadcast(frequent), "token", "left")
    listed = F.broadcast(frequent.select("token"))
    rare = words.where(F.col("token").isNotNull()).join(listed, "token", "left_anti")
    for model in models:
        rare = rare.join(_weights(model).join(listed, "token", "left_anti").hint("merge"), "token", "left")
    known = reduce(Column.__or__, [F.col(f"w_{model.name}").isNotNull() for model in models])
    return placed.unionByName(rare.where(known))


def window_scores(
    articles: DataFrame,
    models: Sequence[Model],
    key: Sequence[str],
    text: str = "article",
    broadcast_bytes: int = BROADCAST_BYTES,
    tokenize: Callable[[Column], Column] = tokens,
    frequent_bytes: int = FREQUENT_BYTES,
) -> DataFrame:
    """Per key and window: score array and count of known words for each model.

    Models that measure at most `broadcast_bytes` together are sent to every executor: all words of a text
    come from one row, so sums are complete before the shuffle, which carries one row per window.
    Of larger ones the most frequent words are, up to `frequent_bytes`; the others are joined by a shuffle of
    the words that are none of these. Both give the same scores.
    """
    words = window_words(articles, key, text, tokenize)
    if fits_broadcast(models, broadcast_bytes):
        for model in models:
            words = words.join(F.broadcast(_weights(model)), "token", "left")
    else:
        words = _weigh_by_shuffle(words, models, frequent_bytes)
    sums: list[Column] = [F.max("has_text").alias("has_text")]
    for model in models:
        weights = f"w_{model.name}"
        sums.append(F.count(weights).alias(f"known_{model.name}"))
        sums.append(class_sums(weights, len(model.labels)).alias(f"scores_{model.name}"))
    return words.groupBy(*key, "window").agg(*sums)


def window_label_index(model: Model) -> Column:
    """Class index of a window; `neutral` when no word is known, null for a null text."""
    known = F.when(F.col(f"known_{model.name}") > 0, argmax(F.col(f"scores_{model.name}")))
    index = F.coalesce(known, F.lit(list(model.labels).index(NEUTRAL)))
    return F.when(F.col("has_text"), index).cast("int")


def window_labels(scores: DataFrame, models: Sequence[Model], key: Sequence[str]) -> DataFrame:
    """Label name of every window, one column per model."""
    return scores.select(
        *key, "window", *[label_of(window_label_index(m), m.labels).alias(m.name) for m in models]
    )


def article_labels(
    labels: DataFrame, models: Sequence[Model], key: Sequence[str], *also: Column
) -> DataFrame:
    """Majority label over the windows of each article, null when no window has one; `also` are more aggregates."""
    votes = labels.groupBy(*key).agg(*[label_votes(m.name, m.labels).alias(m.name) for m in models], *also)
    more = [c for c in votes.columns if c not in key and c not in {m.name for m in models}]
    return votes.select(*key, *[elected(F.col(m.name), m.labels).alias(m.name) for m in models], *more)


def label_keys(
    articles: DataFrame,
    models: Sequence[Model],
    key: Sequence[str],
    text: str = "article",
    broadcast_bytes: int = BROADCAST_BYTES,
    tokenize: Callable[[Column], Column] = tokens,
) -> DataFrame:
    """Key and labels of every article; texts that share a key are scored as one."""
    scores = window_scores(articles, models, key, text, broadcast_bytes, tokenize)
    return article_labels(window_labels(scores, models, key), models, key)


def article_digest(key: Sequence[str], text: str) -> Column:
    """Digest of key columns and text; lengths and marks keep nulls and neighbours apart."""
    parts = []
    for name in [*key, text]:
        value = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(value), F.lit(":"), value), F.lit("-")))
    return F.md5(F.concat(*parts))


def label_articles(
    articles: DataFrame,
    models: Sequence[Model],
    key: Sequence[str] = ("id", "batch"),
    text: str = "article",
    broadcast_bytes: int = BROADCAST_BYTES,
    tokenize: Callable[[Column], Column] = tokens,
) -> DataFrame:
    """The articles with one label column per model; row for row, also for null or repeated keys.

    One digest of key and text, never null, is what articles are scored and joined by: no row
    is multiplied, different texts under one key keep their own labels, and the labels arrive at the
    join already partitioned by it.
    """
    digested = articles.withColumn("_article", article_digest(key, text))
    labels = label_keys(digested, models, ["_article"], text, broadcast_bytes, tokenize)
    return digested.join(labels, "_article", "left").select(*articles.columns, *[m.name for m in models])
