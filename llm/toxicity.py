"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is a learned vector of the word itself and the mean of learned vectors of its
character n-grams, all hashed. Texts are read in overlapping windows; the network runs over a
window in both directions, attention pools its states, and a text's score is that of its highest
window. Training therefore works on the highest window of each text.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import held_out, learning_sample, ship, slices
from llm.features import Words, char_ngrams, split_words, word_hashes

WINDOW, STRIDE = 32, 24
WORD_BUCKETS, CHAR_BUCKETS = 1 << 14, 1 << 17
WORD_DIMENSIONS, CHAR_DIMENSIONS, HIDDEN, ATTENTION = 8, 8, 8, 8
CHAR_SIZES = range(4, 6)
# Learned from at most so many labelled documents of each class.
SAMPLE_PER_CLASS = 800
ROUNDS, BATCH, RATE = 7, 32, 0.01
THRESHOLD = 0.7
# Windows that run through the network at once.
CHUNK = 2048

Parameters = dict[str, np.ndarray]


@dataclass
class Inputs:
    """Distinct words as buckets, and for every window its text and its word places."""

    word: np.ndarray
    owner: np.ndarray
    grams: np.ndarray
    text: np.ndarray
    first: np.ndarray
    length: np.ndarray
    ids: np.ndarray


def prepare(texts: pa.Array) -> Inputs:
    """Windows of WINDOW words, STRIDE apart, that cover each whole text; an empty text has one empty word."""
    words: Words = split_words(texts, lower=True, empty_word=True)
    owner, grams = char_ngrams(words.distinct, CHAR_SIZES, CHAR_BUCKETS)
    sizes = np.diff(words.starts)
    windows = np.maximum(0, -(-(sizes - WINDOW) // STRIDE)) + 1
    text = np.repeat(np.arange(len(sizes)), windows)
    number = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    first = words.starts[:-1][text] + number * STRIDE
    length = np.minimum(WINDOW, words.starts[1:][text] - first)
    word = (word_hashes(words.distinct) % np.uint64(WORD_BUCKETS)).astype(np.int64)
    return Inputs(word, owner, grams, text, first, length, words.ids)


def new_parameters(seed: int = 11) -> Parameters:
    rng = np.random.default_rng(seed)
    width = WORD_DIMENSIONS + CHAR_DIMENSIONS

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "words": normal(WORD_BUCKETS, WORD_DIMENSIONS, scale=0.1),
        "chars": normal(CHAR_BUCKETS, CHAR_DIMENSIONS, scale=0.3),
        "input": normal(2, width, 3 * HIDDEN, scale=width**-0.5),
        "bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
        "state": normal(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
        "attend": normal(2 * HIDDEN, ATTENTION, scale=(2 * HIDDEN) ** -0.5),
        "pick": normal(ATTENTION, scale=1.0),
        "out": normal(2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5),
        "offset": np.zeros(1, np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    y = 0.5 * x
    np.tanh(y, out=y)
    y *= 0.5
    y += 0.5
    return y


def _vectors(p: Parameters, word: np.ndarray, owner: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Inputs of distinct words: the word's own vector, then the mean of its n-grams' vectors."""
    n = len(word)
    count = np.maximum(np.bincount(owner, minlength=n), 1).astype(np.float32)
    sums = np.zeros((n, CHAR_DIMENSIONS), p["chars"].dtype)
    ends = [0, *np.flatnonzero(np.diff(owner) < 0) + 1, len(owner)]
    for start, end in zip(ends, ends[1:]):
        own = owner[start:end]
        at = np.flatnonzero(np.diff(own, prepend=-1))
        if len(at):
            sums[own[at]] += np.add.reduceat(p["chars"][grams[start:end]], at, axis=0)
    return np.concatenate([p["words"][word], sums / count[:, None]], axis=1)


def _run(p: Parameters, gates: np.ndarray, ids: np.ndarray, length: np.ndarray, keep: bool = False):
    """Logits of windows. ids: (steps, windows) words of each step; gates: input gates of each word.

    Words after a window's end do not reach the backward state and get no attention. With `keep`
    also what the backward pass needs.
    """
    steps, n = ids.shape
    states = np.zeros((2, steps + 1, n, HIDDEN), np.float32)
    kept = []
    hidden = np.zeros((2, n, HIDDEN), np.float32)
    x = np.empty((2, n, 3 * HIDDEN), gates.dtype)
    shortest = int(length.min())
    for t in range(steps):
        back = steps - 1 - t
        np.take(gates[0], ids[t], axis=0, out=x[0], mode="clip")
        np.take(gates[1], ids[back], axis=0, out=x[1], mode="clip")
        recurrent = hidden @ p["state"]
        x[..., : 2 * HIDDEN] += recurrent[..., : 2 * HIDDEN]
        zr = _sigmoid(x[..., : 2 * HIDDEN])
        z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        new = r * recurrent[..., 2 * HIDDEN :]
        new += x[..., 2 * HIDDEN :]
        np.tanh(new, out=new)
        before = hidden
        hidden = new + z * (hidden - new)
        inside = (back < length).astype(np.float32)[:, None]
        if back >= shortest:
            hidden[1] *= inside
        states[0, t], states[1, back] = hidden
        if keep:
            kept.append((before, z, r, new, recurrent, inside))
    both = np.concatenate([states[0, :steps], states[1, :steps]], axis=-1)
    seen = np.tanh(both @ p["attend"])
    weight = np.where(np.arange(steps)[:, None] < length, seen @ p["pick"], -np.inf)
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", weight, both)
    logits = pooled @ p["out"] + p["offset"][0]
    return (logits, (kept, both, seen, weight, pooled)) if keep else logits


def _steps(inputs: Inputs, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    length = inputs.length[chosen]
    places = inputs.first[chosen] + np.arange(int(length.max()))[:, None]
    return inputs.ids[np.minimum(places, len(inputs.ids) - 1)], length


def _gates(p: Parameters, vectors: np.ndarray) -> np.ndarray:
    return vectors @ p["input"] + p["bias"]


def window_logits(p: Parameters, inputs: Inputs) -> np.ndarray:
    """Logit of every window, in bounded pieces; short windows apart from whole ones."""
    gates = _gates(p, _vectors(p, inputs.word, inputs.owner, inputs.grams))
    logits = np.empty(len(inputs.text), np.float32)
    order = np.argsort(inputs.length, kind="stable")
    for start in range(0, len(order), CHUNK):
        chosen = order[start : start + CHUNK]
        ids, length = _steps(inputs, chosen)
        logits[chosen] = _run(p, gates, ids, length)
    return logits


def score_texts(p: Parameters, texts: pa.Array) -> np.ndarray:
    """Probability of class 1 of every whole text: that of its highest window."""
    inputs = prepare(texts)
    starts = np.searchsorted(inputs.text, np.arange(len(texts)))
    highest = np.maximum.reduceat(window_logits(p, inputs), starts)
    return 1 / (1 + np.exp(-np.clip(highest.astype(np.float64), -30, 30)))


def gradients(p: Parameters, inputs: Inputs, chosen: np.ndarray, label: np.ndarray) -> tuple[Parameters, tuple]:
    """Gradients of the mean log loss over the chosen windows, by back-propagation through time.

    Those of the vector tables are returned as (rows, gradients).
    """
    ids, length = _steps(inputs, chosen)
    used, ids = np.unique(ids, return_inverse=True)
    ids = ids.reshape(-1, len(chosen))
    place = np.full(len(inputs.word), -1)
    place[used] = np.arange(len(used))
    owner = place[inputs.owner]
    owner, grams, word = owner[owner >= 0], inputs.grams[owner >= 0], inputs.word[used]
    vectors = _vectors(p, word, owner, grams)
    gates = _gates(p, vectors)
    logits, (kept, both, seen, weight, pooled) = _run(p, gates, ids, length, keep=True)
    steps, n = ids.shape
    g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("words", "chars")}
    error = ((1 / (1 + np.exp(-logits)) - label) / n).astype(np.float32)
    g["offset"][0] = error.sum()
    g["out"] = pooled.T @ error
    d_pooled = error[:, None] * p["out"]
    d_both = weight[..., None] * d_pooled
    d_weight = np.einsum("tnh,nh->tn", both, d_pooled)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["pick"] = np.einsum("tn,tna->a", d_score, seen)
    d_seen = d_score[..., None] * p["pick"] * (1 - seen**2)
    g["attend"] = np.einsum("tnh,tna->ha", both, d_seen)
    d_both = d_both + d_seen @ p["attend"].T
    d_steps = np.empty((2, steps, n, 3 * HIDDEN), gates.dtype)
    carry = np.zeros((2, n, HIDDEN), np.float32)
    state = p["state"].transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        before, z, r, new, recurrent, inside = kept[t]
        back = steps - 1 - t
        d = carry + np.stack([d_both[t, :, :HIDDEN], d_both[back, :, HIDDEN:]])
        d[1] *= inside
        d_new = d * (1 - z) * (1 - new**2)
        d_z = d * (before - new) * z * (1 - z)
        d_r = d_new * recurrent[..., 2 * HIDDEN :] * r * (1 - r)
        d_recurrent = np.concatenate([d_z, d_r, d_new * r], axis=-1)
        d_input = np.concatenate([d_z, d_r, d_new], axis=-1)
        g["state"] += before.transpose(0, 2, 1) @ d_recurrent
        carry = d * z + d_recurrent @ state
        d_steps[0, t], d_steps[1, back] = d_input
    d_gates = np.stack([_sum_rows(ids.ravel(), d.reshape(ids.size, -1), len(used)) for d in d_steps])
    g["bias"] = d_gates.sum(axis=1, keepdims=True)
    g["input"] = vectors.T @ d_gates
    d_vectors = (d_gates @ p["input"].transpose(0, 2, 1)).sum(axis=0)
    count = np.maximum(np.bincount(owner, minlength=len(used)), 1)
    d_chars = (d_vectors[:, WORD_DIMENSIONS:] / count[:, None])[owner]
    return g, ((word, d_vectors[:, :WORD_DIMENSIONS]), (grams, d_chars))


def _sum_rows(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values of each of n rows."""
    order = np.argsort(rows, kind="stable")
    present, at = np.unique(rows[order], return_index=True)
    sums = np.zeros((n, values.shape[1]), values.dtype)
    if len(order):
        sums[present] = np.add.reduceat(values[order], at, axis=0)
    return sums


def _adam(p: Parameters, g: Parameters, memory: dict, step: int, rate: float) -> None:
    for key, grad in g.items():
        m, v = memory.setdefault(key, (np.zeros_like(grad), np.zeros_like(grad)))
        m += 0.1 * (grad - m)
        v += 0.01 * (grad**2 - v)
        p[key] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)


def _scaled_step(table: np.ndarray, memory: np.ndarray, rows: np.ndarray, grad: np.ndarray, rate: float) -> None:
    """Update of the rows of a vector table that occur, each by its own gradient history."""
    used, at = np.unique(rows, return_inverse=True)
    total = _sum_rows(at, grad.astype(np.float32), len(used))
    memory[used] += (total**2).mean(axis=1)
    table[used] -= rate * total / (np.sqrt(memory[used])[:, None] + 1e-6)


def train(sample: list[tuple[str, int]], rounds: int = ROUNDS, seed: int = 5) -> Parameters:
    """Each round scores all windows of the sample, then learns from the highest of every text.

    Texts of class 0 also give a window at random. The first round takes windows at random.
    Without both classes the network answers 0.5 for everything.
    """
    p = new_parameters()
    if len({label for _, label in sample}) < 2:
        p["out"][:] = 0
        return p
    rng = np.random.default_rng(seed)
    inputs = prepare(pa.array([text for text, _ in sample], pa.large_string()))
    labels = np.array([label for _, label in sample], np.float32)[inputs.text]
    memory: dict = {}
    history = np.zeros(WORD_BUCKETS, np.float32), np.zeros(CHAR_BUCKETS, np.float32)
    step = 0
    for number in range(rounds):
        rank = window_logits(p, inputs) if number else rng.random(len(labels), np.float32)
        chosen = [_highest(inputs.text, rank)]
        other = _highest(inputs.text, rng.random(len(labels), np.float32))
        chosen.append(other[labels[other] == 0])
        order = rng.permutation(np.unique(np.concatenate(chosen)))
        for start in range(0, len(order), BATCH):
            step += 1
            batch = order[start : start + BATCH]
            rate = RATE * (1 - 0.8 * number / rounds)
            g, tables = gradients(p, inputs, batch, labels[batch])
            _adam(p, g, memory, step, rate)
            for key, past, (rows, grad) in zip(("words", "chars"), history, tables):
                _scaled_step(p[key], past, rows, grad, 10 * rate)
    return p


def _highest(text: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The window of highest rank of each text."""
    order = np.lexsort((rank, text))
    last = np.append(text[order][1:] != text[order][:-1], True)
    return order[last]


def score_documents(documents: DataFrame, p: Parameters, threshold: float = THRESHOLD) -> DataFrame:
    """The documents' ids with held_out, score and predicted, row for row.

    Null and empty texts are one empty word; ids may be null or repeat.
    """
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(p)
    kind = documents.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            scores = pa.array(score_texts(shared.value, texts), pa.float64())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), scores], ["doc_id", "score"])

    scored = documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def fit(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Parameters:
    """A network for `labels.toxic` from a bounded sample of rows that are not held out."""
    return train(learning_sample(documents, labels, "toxic", per_class))
