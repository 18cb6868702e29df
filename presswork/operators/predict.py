"""Labels from a pluggable scorer inside Arrow batches: map-only, no shuffle."""

import fcntl
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.functions.constants import NEUTRAL, WINDOW_TOKENS
from presswork.functions.tokens import tokens
from presswork.operators.models import Model, model_size
from presswork.sources.shared import mounted_path, new_path

Scorer = Callable[[pa.Array], pa.RecordBatch]
# Largest models, together, that a machine maps into memory.
MACHINE_BYTES = 8 << 30
# Windows whose words' weights are looked up at a time.
_WINDOWS_TOGETHER = 256


def predict_labels(
    articles: DataFrame,
    make_scorer: Callable[[], Scorer],
    outputs: list[str],
    text: str = "article",
    given: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The articles with the scorer's string columns; each task builds its scorer once.

    The scorer takes an Arrow array, the texts or what `given` makes of them by SQL, and returns a
    record batch with the output columns, row for row.
    """
    source = given(F.col(text)) if given else F.col(text)
    rows = articles.select(F.struct(*articles.columns).alias("row"), source.alias("given"))
    columns = articles.schema.fields
    schema = T.StructType([*columns, *[T.StructField(name, T.StringType()) for name in outputs]])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = make_scorer()
        for batch in batches:
            labels = scorer(batch.column("given"))
            found = [labels.column(name) for name in outputs]
            yield pa.RecordBatch.from_arrays([*batch.column("row").flatten(), *found], names)

    return rows.mapInArrow(run, schema)


def word_keys(text: Column) -> Column:
    """What the linear scorer is given: two digests of every word, 128 bits together; null for a null text."""

    def digests(words: Column) -> Column:
        return F.struct(*[F.transform(words, partial(_digest, n)).alias(f"key{n}") for n in (1, 2)])

    return F.when(text.isNotNull(), F.get(F.transform(F.array(tokens(text)), digests), F.lit(0)))


def _digest(number: int, word: Column) -> Column:
    return F.xxhash64(word, F.lit(number))


@dataclass
class WordTable:
    """A model on disk, mapped into memory: sorted first digests, second digests, weights by label."""

    first: np.ndarray
    second: np.ndarray
    weights: np.ndarray

    def places(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Rows of words, by binary search; -1 for words that the model does not know."""
        out = np.full(len(first), -1, np.int64)
        if not len(self.first):
            return out
        at = np.searchsorted(self.first, first)
        open_ = np.flatnonzero(at < len(self.first))
        # Words that share the first digest stand side by side: nearly always one step.
        while len(open_):
            here = at[open_]
            alike = self.first[here] == first[open_]
            open_, here = open_[alike], here[alike]
            hit = self.second[here] == second[open_]
            out[open_[hit]] = here[hit]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < len(self.first)]
        return out


_opened: dict[str, WordTable] = {}


def open_words(folder: str, n_labels: int, place: str | None = None) -> WordTable:
    """The model whose files Spark fetched into a folder, or wrote there where it is mounted; opened once by a process.

    The first process to come turns the files, each a sorted range, into plain columns, file by file; these are
    named after `place`, a path of this machine, and their pages are shared by all that run there. They take
    their names when they are whole, so a process that is ended meanwhile leaves nothing half done.
    """
    place = place or folder
    if place in _opened:
        return _opened[place]
    kinds = {"first": np.int64, "second": np.int64, "weights": np.int32}
    with open(f"{place}.lock", "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.exists(f"{place}.weights"):
            files = [open(f"{place}.{name}.part", "wb") for name in kinds]
            for part in sorted(x for x in os.listdir(folder) if x.startswith("part-")):
                for batch in pq.ParquetFile(f"{folder}/{part}").iter_batches():
                    columns = [batch.column(0), batch.column(1), batch.column(2).flatten()]
                    for file, column, kind in zip(files, columns, kinds.values()):
                        file.write(column.to_numpy(zero_copy_only=False).astype(kind).tobytes())
            for file, name in zip(files, kinds):
                file.close()
                os.replace(f"{place}.{name}.part", f"{place}.{name}")

    def mapped(name: str) -> np.ndarray:
        path = f"{place}.{name}"
        return np.memmap(path, kinds[name], "r") if os.path.getsize(path) else np.zeros(0, kinds[name])

    table = WordTable(mapped("first"), mapped("second"), mapped("weights").reshape(-1, n_labels))
    _opened[place] = table
    return table


def _best(table: WordTable, place: np.ndarray, ends: np.ndarray, neutral: int) -> np.ndarray:
    """Class of every window: the largest sum of its words' weights, the lowest class on a tie."""
    out = np.full(len(ends), neutral, np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    for start in range(0, len(ends), _WINDOWS_TOGETHER):
        stop = min(start + _WINDOWS_TOGETHER, len(ends))
        words = place[begins[start] : ends[stop - 1]]
        known = words >= 0
        before = np.concatenate([[0], np.cumsum(known)])
        edges = before[np.append(begins[start:stop], ends[stop - 1]) - begins[start]]
        held = np.flatnonzero(np.diff(edges))
        if len(held):
            sums = np.add.reduceat(table.weights[words[known]].astype(np.int64), edges[:-1][held], axis=0)
            out[start + held] = sums.argmax(axis=1)
    return out


def _vote(found: np.ndarray, starts: np.ndarray, labels: list[str]) -> list[str]:
    """Most frequent label between starts, the smallest name on a tie."""
    ranked = sorted(range(len(labels)), key=lambda i: labels[i])
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    cells = text * len(labels) + np.argsort(ranked)[found]
    counts = np.bincount(cells, minlength=(len(starts) - 1) * len(labels)).reshape(-1, len(labels))
    return [labels[ranked[i]] for i in counts.argmax(axis=1)]


def linear_scorer(models: list[Model], most_bytes: int = MACHINE_BYTES) -> Callable[[], Scorer]:
    """Factory of a scorer for stored word models that fit a machine's memory, to be given `word_keys`.

    Spark sorts a model by the digest of its words. Executors read the files where the shared folder is mounted, and
    fetch them from any other store; no model passes through the driver. A model is mapped into memory, so that all tasks of an executor share one copy. Larger models are
    for `label_articles`, which joins them by word.
    """
    size = sum(model_size(model) for model in models)
    if size > most_bytes:
        raise ValueError(f"models of {size} bytes outgrow {most_bytes}: join them by word with label_articles")
    spark = models[0].weights.sparkSession
    parts = []
    for model in models:
        path = new_path(spark, f"scorer-{model.name}")
        keys = [_digest(n, F.col("token")).alias(f"key{n}") for n in (1, 2)]
        model.weights.select(*keys, "w").repartitionByRange("key1").sortWithinPartitions("key1").write.parquet(path)
        # Spark hands out no mounted folder on a cluster, where every machine sees it anyway.
        mounted = mounted_path(spark, path)
        if mounted is None:
            spark.sparkContext.addFile(path, recursive=True)
        parts.append((model.name, list(model.labels), path.rsplit("/", 1)[-1], mounted))

    def opened(folder: str, mounted: str | None, labels: list[str]) -> WordTable:
        own = SparkFiles.get(folder)
        return open_words(mounted or own, len(labels), own)

    def make() -> Scorer:
        loaded = [(name, labels, opened(folder, mounted, labels)) for name, labels, folder, mounted in parts]

        def score(keys: pa.Array) -> pa.RecordBatch:
            null = keys.is_null().to_numpy(zero_copy_only=False)
            held = keys.drop_null()
            lists = [held.field(i) for i in range(2)]
            n = pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False).astype(np.int64)
            first, second = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
            # A text has a window for every WINDOW_TOKENS words begun, and one if it has none.
            windows = np.maximum(1, -(-n // WINDOW_TOKENS))
            starts = np.concatenate([[0], np.cumsum(windows)])
            inside = np.arange(starts[-1]) - np.repeat(starts[:-1], windows) + 1
            ends = np.minimum(inside * WINDOW_TOKENS, np.repeat(n, windows)) + np.repeat(np.cumsum(n) - n, windows)
            columns = []
            for _, labels, table in loaded:
                best = _best(table, table.places(first, second), ends, labels.index(NEUTRAL))
                out = np.full(len(null), None, object)
                out[~null] = _vote(best, starts, labels)
                columns.append(pa.array(out, pa.string()))
            return pa.RecordBatch.from_arrays(columns, [name for name, *_ in loaded])

        return score

    return make
