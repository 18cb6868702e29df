"""Quality classifier: supervised subword embeddings, trained by stochastic gradient descent in numpy.

A document is the mean of the learned vectors of its words, word pairs and character n-grams, all
hashed into one table; a softmax layer gives its class. The output is linear in that mean, so for
scoring each vector is reduced to its share of the log-odds once.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import give_back, held_out, learning_sample, mix, ship, slices
from llm.features import Words, char_ngrams, split_words, word_hashes

BUCKETS = 1 << 18
DIMENSIONS = 8
CHAR_SIZES = range(2, 5)
# Learned from at most so many labelled documents of each class.
SAMPLE_PER_CLASS = 2000
EPOCHS = 5
# A small sample is gone through more often.
LEAST_STEPS = 8000
RATE = 0.5
THRESHOLD = 0.5
# Buckets with a meaning of their own: the end of a text, and a word that follows itself.
_END, _REPEAT, _RESERVED = 0, 1, 2


@dataclass
class QualityModel:
    """Log-odds per bucket; without labels of both classes all are 0 and scores are 0.5."""

    odds: np.ndarray


def _features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of distinct words, of their n-grams (owner, bucket), and of pairs at each place."""
    free = np.uint64(BUCKETS - _RESERVED)
    hashes = word_hashes(words.distinct)
    own = (hashes % free).astype(np.int64) + _RESERVED
    owner, grams = char_ngrams(words.distinct, CHAR_SIZES, BUCKETS - _RESERVED)
    pairs = np.full(len(words.ids), -1, np.int64)
    if len(words.ids) > 1:
        left, right = hashes[words.ids[:-1]], hashes[words.ids[1:]]
        with np.errstate(over="ignore"):
            both = (mix(left * np.uint64(3) + right) % free).astype(np.int64) + _RESERVED
        pairs[1:] = np.where(words.ids[:-1] == words.ids[1:], _REPEAT, both)
    starts = words.starts[:-1]
    pairs[starts[starts < len(pairs)]] = -1
    return own, owner, grams + _RESERVED, pairs


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]


def score_texts(model: QualityModel, texts: pa.Array) -> np.ndarray:
    """Probability of class 1 for every whole text."""
    words = split_words(texts)
    own, owner, grams, pairs = _features(words)
    size = len(words.distinct)
    score = model.odds[own] + np.bincount(owner, model.odds[grams], size)
    count = 1.0 + np.bincount(owner, minlength=size)
    paired = pairs >= 0
    at = score[words.ids] + np.where(paired, model.odds[pairs], 0.0)
    total = _sums(at, words.starts) + model.odds[_END]
    n = _sums(count[words.ids] + paired, words.starts) + 1
    return 1 / (1 + np.exp(-np.clip(total / n, -30, 30)))


def train(sample: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 7) -> QualityModel:
    """Learned vectors and softmax weights, from (text, class) pairs; one document per step."""
    if len({label for _, label in sample}) < 2:
        return QualityModel(np.zeros(BUCKETS, np.float32))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((2, DIMENSIONS), np.float32)
    documents = []
    for text, label in sample:
        words = split_words(pa.array([text], pa.large_string()))
        own, owner, grams, pairs = _features(words)
        times = np.bincount(words.ids, minlength=len(own))
        found = np.concatenate([[_END], own, grams, pairs[pairs >= 0]])
        often = np.concatenate([[1], times, times[owner], np.ones((pairs >= 0).sum(), np.int64)])
        buckets, place = np.unique(found, return_inverse=True)
        share = np.bincount(place, often).astype(np.float32)
        documents.append((buckets.astype(np.int32), share / share.sum(), label))
    steps = max(epochs * len(documents), LEAST_STEPS)
    for step in range(steps):
        if step % len(documents) == 0:
            order = rng.permutation(len(documents))
        buckets, share, label = documents[order[step % len(documents)]]
        hidden = share @ vectors[buckets]
        logits = weights @ hidden
        error = np.exp(logits - logits.max())
        error /= error.sum()
        error[label] -= 1
        rate = RATE * (1 - step / steps)
        back = weights.T @ error
        weights -= rate * np.outer(error, hidden)
        vectors[buckets] -= rate * share[:, None] * (len(buckets) ** 0.5) * back
    return QualityModel((vectors @ (weights[1] - weights[0])).astype(np.float32))


def score_rows(documents: DataFrame, model: QualityModel, name: str = "_score") -> DataFrame:
    """The documents, whatever their columns, with the score under a new name. Null texts count as empty."""
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            scores = pa.array(score_texts(shared.value, texts), pa.float64())
            yield pa.RecordBatch.from_arrays([*rows.columns, scores], [*rows.schema.names, name])

    return documents.mapInArrow(run, schema)


def score_documents(documents: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents' ids with held_out, score and predicted, row for row; ids may be null or repeat."""
    scored = score_rows(documents.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents of class 1, with their columns."""
    name = "_score"
    while name in documents.columns:
        name += "_"
    return score_rows(documents, model, name).where(F.col(name) >= threshold).select(documents.columns)


def fit(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> QualityModel:
    """A model of `labels.quality` from a bounded sample of rows that are not held out."""
    model = train(learning_sample(documents, labels, "quality", per_class))
    # Thousands of small arrays are free now, but still counted to the driver.
    give_back()
    return model
