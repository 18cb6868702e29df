"""Language of documents that may mix several: proportions by expectation-maximisation over word likelihoods.

A word's likelihood under a language is a chain of character n-gram probabilities, trigrams backed off to
bigrams and single characters. A document is a mixture of languages, each word drawn from one of them.
Its set of languages begins with the likeliest and grows while the likelihood gains more than a penalty.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import held_out, mix, ship, slices
from llm.features import Words, letter_runs

UNKNOWN = "und"
SLICE_BYTES = 4 << 20
# Hashed counts by kind: character, context of one, pair, context of two, triple; sizes as powers of two.
BITS = (9, 9, 13, 13, 16)
BACKOFF = 4.0
# A word speaks for a language against another by at most this much, as a natural logarithm.
MOST_PER_WORD = 8.0
# Gain in log-likelihood that a further language must bring: PENALTY + log(words) / 2.
PENALTY = 4.0
ROUNDS, CLOSE = 40, 1e-3
# Languages whose counts a learning task holds before it hands them on.
HELD_LANGUAGES = 64


def clean_words(texts: pa.Array) -> Words:
    """Words of letters in small letters; runs without any letter are left out."""
    words = letter_runs(texts)
    letters = pc.match_substring_regex(words.distinct, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
    kept = letters[words.ids] if len(words.ids) else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(kept)])
    return Words(words.ids[kept], before[words.starts], pc.utf8_lower(words.distinct))


def grams(words: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The word of every character and of its end, and its bucket of each kind."""
    text = words.to_pylist()
    lengths = np.fromiter(map(len, text), np.int64, len(text)) + 3
    joined = "".join(f"<<{w}>" for w in text)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    last = np.ones(len(chars), bool)
    last[starts] = last[starts + 1] = False
    at = np.flatnonzero(last)
    c, b, a = chars[at], chars[at - 1], chars[at - 2]
    one, two = np.uint64(21), np.uint64(42)
    keys = (c, b, (b << one) | c, (a << one) | b, (a << two) | (b << one) | c)
    buckets = [(mix(k + np.uint64(1)) & np.uint64((1 << bits) - 1)).astype(np.int64) for k, bits in zip(keys, BITS)]
    return np.repeat(np.arange(len(text)), lengths - 2), buckets


def gram_counts(documents: DataFrame) -> DataFrame:
    """lang, kind, bucket and n over all documents with a language whose label may be learned."""
    ship(documents.sparkSession)
    known = documents.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())

    def rows_of(held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, tables in held.items():
            for kind, table in enumerate(tables):
                found = np.flatnonzero(table)
                columns = [pa.array([lang] * len(found), pa.string()), pa.array(np.full(len(found), kind), pa.int32())]
                columns += [pa.array(found, pa.int32()), pa.array(table[found].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "kind", "bucket", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        for rows, texts in slices(batches, "text", SLICE_BYTES):
            words = clean_words(texts)
            owner, buckets = grams(words.distinct)
            codes = rows.column("lang").dictionary_encode()
            lang = np.repeat(codes.indices.to_numpy().astype(np.int64), np.diff(words.starts))
            for number, name in enumerate(codes.dictionary.to_pylist()):
                times = np.bincount(words.ids[lang == number], minlength=len(words.distinct)).astype(np.float64)
                tables = held.setdefault(name, [np.zeros(1 << bits) for bits in BITS])
                for table, bucket in zip(tables, buckets):
                    table += np.bincount(bucket, times[owner], len(table))
                if len(held) >= HELD_LANGUAGES:
                    yield from rows_of(held)
                    held = {}
        yield from rows_of(held)

    found = known.select("lang", "text").mapInArrow(run, "lang string, kind int, bucket int, n bigint")
    return found.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Languages:
    """Names in order, and for each kind of count one row of buckets per language: 0.3 MB a language."""

    names: list[str]
    tables: list[np.ndarray]

    def word_likelihoods(self, words: pa.Array) -> np.ndarray:
        """Logarithm of every word's likelihood under every language, against the word's best one."""
        owner, (single, one, pair, two, triple) = grams(words)
        out = np.zeros((len(words), len(self.names)), np.float64)
        for number in range(len(self.names)):
            chars, ones, pairs, twos, triples = (t[number] for t in self.tables)
            p = (chars[single] + 1) / (chars.sum() + len(chars))
            p = (pairs[pair] + BACKOFF * p) / (ones[one] + BACKOFF)
            p = (triples[triple] + BACKOFF * p) / (twos[two] + BACKOFF)
            out[:, number] = np.bincount(owner, np.log(p), len(words))
        return np.maximum(out - out.max(axis=1, keepdims=True, initial=-np.inf), -MOST_PER_WORD)


def learn(documents: DataFrame) -> Languages:
    """Counts of all documents that may be learned from, summed by Spark; the driver gets at most 83,000 numbers a language."""
    found = gram_counts(documents).toArrow()
    names = sorted(set(found["lang"].to_pylist()))
    place = {name: i for i, name in enumerate(names)}
    tables = [np.zeros((len(names), 1 << bits)) for bits in BITS]
    codes = found["lang"].combine_chunks().dictionary_encode()
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    row = np.array([place[x] for x in codes.dictionary.to_pylist()], np.int64)[codes.indices.to_numpy()] if names else []
    kind, bucket, n = (found[c].to_numpy() for c in ("kind", "bucket", "n"))
    for number, table in enumerate(tables):
        mine = kind == number
        if mine.any():
            table[row[mine], bucket[mine]] = n[mine]
    return Languages(names, [t.astype(np.float32) for t in tables])


@dataclass
class Mixture:
    """Languages of every text, their proportions (both in slots, -1 and 0 where empty), and the single likelihoods."""

    chosen: np.ndarray
    shares: np.ndarray
    single: np.ndarray


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts[:-1], axis=0) if len(values) else np.zeros((len(starts) - 1, *values.shape[1:]))


def _maximise(likely: np.ndarray, shares: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions by expectation-maximisation, and the log-likelihood that they reach."""
    sizes = np.diff(starts)
    shares, moving = shares.copy(), np.arange(len(sizes))
    words, edges, n = likely, starts, sizes
    for _ in range(ROUNDS):
        part = words * np.repeat(shares[moving], n, axis=0)
        part /= part.sum(axis=1, keepdims=True)
        new = _sums(part, edges) / n[:, None]
        far = np.abs(new - shares[moving]).max(axis=1) > CLOSE
        shares[moving] = new
        if not far.any():
            break
        if not far.all():
            words, moving, n = words[np.repeat(far, n)], moving[far], n[far]
            edges = np.concatenate([[0], np.cumsum(n)])
    reached = _sums(np.log((likely * np.repeat(shares, sizes, axis=0)).sum(axis=1)), starts)
    return shares, reached


def infer(likelihoods: np.ndarray, ids: np.ndarray, starts: np.ndarray, penalty: float = PENALTY) -> Mixture:
    """The mixture of every text, from its words' likelihoods; texts without words keep empty slots.

    The log-likelihood is concave in the proportions, so its slope bounds what a further language can gain:
    a text whose steepest slope stays under the penalty is done without a trial, by proof.
    """
    texts, languages = len(starts) - 1, likelihoods.shape[1]
    chosen, shares = np.full((texts, languages), -1, np.int64), np.zeros((texts, languages))
    single = np.zeros((texts, languages))
    filled = np.flatnonzero(np.diff(starts))
    if not languages or not len(filled):
        return Mixture(chosen, shares, single)
    edges = np.concatenate([starts[filled], [len(ids)]])
    single[filled] = np.column_stack([_sums(likelihoods[ids, i], edges) for i in range(languages)])
    chosen[filled, 0], shares[filled, 0] = single[filled].argmax(axis=1), 1.0
    level = single[filled].max(axis=1)
    plain = np.exp(likelihoods)
    for size in range(1, languages):
        n = np.diff(starts)[filled]
        edges = np.concatenate([[0], np.cumsum(n)])
        mine = np.repeat(starts[filled] - edges[:-1], n) + np.arange(edges[-1])
        word = ids[mine]
        held = np.repeat(chosen[filled, :size], n, axis=0)
        mixed = (plain[word[:, None], held] * np.repeat(shares[filled, :size], n, axis=0)).sum(axis=1)
        slope = np.column_stack([_sums(plain[word, i] / mixed, edges) for i in range(languages)])
        np.put_along_axis(slope, chosen[filled, :size], -np.inf, axis=1)
        need = penalty + np.log(n) / 2
        tried = slope.max(axis=1) - n > need
        if not tried.any():
            break
        filled, level, need, more = filled[tried], level[tried], need[tried], slope[tried].argmax(axis=1)
        kept = np.repeat(tried, n)
        n = n[tried]
        slots = np.column_stack([chosen[filled, :size], more])
        begin = np.column_stack([shares[filled, :size] * (1 - 1 / (size + 1)), np.full(len(filled), 1 / (size + 1))])
        likely = plain[word[kept][:, None], np.repeat(slots, n, axis=0)]
        found, reached = _maximise(likely, begin, np.concatenate([[0], np.cumsum(n)]))
        better = reached - level > need
        filled, level = filled[better], reached[better]
        chosen[filled, : size + 1], shares[filled, : size + 1] = slots[better], found[better]
        if not len(filled):
            break
    return Mixture(chosen, shares, single)


def answers(of: Languages, texts: pa.Array) -> tuple[list[str], np.ndarray, list[list[str]], list[list[float]]]:
    """Language, score, all languages and their shares of every text; the larger share comes first."""
    words = clean_words(texts)
    found = infer(of.word_likelihoods(words.distinct), words.ids, words.starts)
    names, scores, sets, parts = [], np.zeros(len(texts)), [], []
    for i in range(len(texts)):
        held = [(-s, -found.single[i, c], c) for c, s in zip(found.chosen[i], found.shares[i]) if c >= 0]
        held.sort()
        sets.append([of.names[c] for *_, c in held])
        parts.append([-s for s, *_ in held])
        names.append(sets[-1][0] if held else UNKNOWN)
        if held:
            best = held[0][2]
            others = np.delete(found.single[i], best)
            margin = found.single[i, best] - others.max() if len(others) else np.inf
            scores[i] = parts[-1][0] / (1 + np.exp(-np.clip(margin, -30, 30)))
    return names, np.clip(scores, 0.0, 1.0), sets, parts


def identify(documents: DataFrame, of: Languages) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages and shares of every document, row for row.

    `lang_pred` is the language of the largest share; equal shares go by the likelihood of the whole text, then
    by name. It is `und`, with score 0 and no languages, if the text is null or has no letter, or nothing was
    learned. `score` is that share times the probability of the language against the next likeliest one.
    Ids may be null or repeat; a null id is not held out. Other columns are ignored.
    """
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(of)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text", SLICE_BYTES):
            names, scores, sets, parts = answers(shared.value, texts)
            columns = [rows.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)]
            columns += [pa.array(sets, pa.list_(pa.string())), pa.array(parts, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "languages", "shares"])

    schema = f"doc_id {kind}, lang_pred string, score double, languages array<string>, shares array<double>"
    found = documents.select("doc_id", "text").mapInArrow(run, schema)
    flag = held_out(F.col("doc_id")).alias("held_out")
    return found.select("doc_id", flag, "lang_pred", "score", "languages", "shares")
