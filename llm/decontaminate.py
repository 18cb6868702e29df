"""Benchmark decontamination: pigeonhole edit matching.

An item of which a document may hold a copy with up to k edits is cut into k + 1 pieces: one of them must
stand in the copy unchanged. Pieces of all items are found by one automaton per pass over a text;
around each hit the whole item is looked for by Myers' bit-parallel edit distance.

Items and texts are compared as lower-case words set apart by one space. Short items are looked for as
they are, between word bounds.
"""

import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import ship, slices

# Edits allowed per character of an item.
ERROR_RATE = 0.08
# Items with fewer characters are found without edits only, and only as whole words.
MIN_CHARS = 24
# Item text that one pass over the documents looks for; more items take more passes.
PASS_BYTES = 2 << 20

_WORD = re.compile(r"[^\W_]+")
# Scripts that are written without spaces, where a word may end at any character: Thai, Lao, Myanmar,
# Khmer, kana, bopomofo and Han.
_UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf"
    "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]"
)


def normalise(text: str) -> str:
    return " ".join(_WORD.findall(text.lower()))


def budget(length: int, rate: float = ERROR_RATE) -> int:
    return int(length * rate) if length >= MIN_CHARS else 0


def at_bound(text: str, place: int) -> bool:
    """Whether a word may begin or end at a place of a normalised text."""
    if place in (0, len(text)):
        return True
    left, right = text[place - 1], text[place]
    return " " in (left, right) or bool(_UNSPACED.match(left) or _UNSPACED.match(right))


def split_pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of nearly equal length that make up the item, with their places."""
    bounds = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(bounds, bounds[1:])]


class Pattern:
    """An item and, per character, the bits of the places where it stands."""

    def __init__(self, text: str):
        self.size = len(text)
        self.bits: dict[str, int] = {}
        for i, char in enumerate(text):
            self.bits[char] = self.bits.get(char, 0) | 1 << i

    def nearest(self, text: str, anchored: bool = False) -> tuple[int, int]:
        """Lowest edit distance between the pattern and a part of the text, and the first end of such a part.

        A part may start anywhere, or only at the start of the text if `anchored`.
        """
        ones = (1 << self.size) - 1
        top = 1 << (self.size - 1)
        rises, falls, score = ones, 0, self.size
        best, end = score, 0
        get = self.bits.get
        for i, char in enumerate(text, 1):
            same = get(char, 0)
            across = (((same & rises) + rises) ^ rises) | same
            down = same | falls
            up = falls | (ones & ~(across | rises))
            low = rises & across
            if up & top:
                score += 1
            elif low & top:
                score -= 1
            up = (up << 1 | anchored) & ones
            low = (low << 1) & ones
            rises = low | (ones & ~(down | up))
            falls = up & down
            if score < best:
                best, end = score, i
        return best, end


class Matcher:
    """Finds items in texts."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = ERROR_RATE):
        self.items = []
        self.finder = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            number, errors = len(self.items), budget(len(text), rate)
            self.items.append((item_id, errors, Pattern(text), Pattern(text[::-1])))
            for at, piece in split_pieces(text, errors):
                places.setdefault(piece, []).append((number, at))
        for piece, found in places.items():
            self.finder.add_word(piece, (len(piece), found))
        if places:
            self.finder.make_automaton()

    def find(self, text: str) -> list[tuple[int | None, int, int, int, int, int]]:
        """(item, distance, budget, start, end, item length) of the nearest copy of each item in a normalised text."""
        if not self.items:
            return []
        hits: dict[int, list[int]] = {}
        whole: dict[int, int] = {}
        for last, (size, found) in self.finder.iter(text):
            for number, at in found:
                start = last + 1 - size - at
                if self.items[number][2].size >= MIN_CHARS:
                    hits.setdefault(number, []).append(start)
                elif number not in whole and at_bound(text, start) and at_bound(text, last + 1):
                    # A short item is one piece, so that a hit is a copy.
                    whole[number] = start
        matches = []
        for number, start in whole.items():
            item_id, errors, pattern, _ = self.items[number]
            matches.append((item_id, 0, errors, start, start + pattern.size, pattern.size))
        for number, starts in hits.items():
            item_id, errors, pattern, mirrored = self.items[number]
            best = None
            for low, high in _joined(starts, errors):
                first = max(0, low - errors)
                distance, end = pattern.nearest(text[first : max(0, high + pattern.size + errors)])
                if distance <= errors and (best is None or distance < best[0]):
                    best = distance, first + end
            if best:
                distance, end = best
                before = text[max(0, end - pattern.size - errors) : end][::-1]
                _, back = mirrored.nearest(before, anchored=True)
                matches.append((item_id, distance, errors, end - back, end, pattern.size))
        return matches


def _joined(starts: list[int], reach: int) -> Iterator[tuple[int, int]]:
    """Ranges of places that lie within reach of each other."""
    starts = sorted(set(starts))
    low = high = starts[0]
    for start in starts[1:]:
        if start - high > reach:
            yield low, high
            low = start
        high = start
    yield low, high


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Where a span of the normalised text stands in the text, in code points."""
    lowered = text.lower()
    at, span = 0, [0, 0]
    for word in _WORD.finditer(lowered):
        after = at + len(word.group())
        if at <= start <= after:
            span[0] = word.start() + start - at
        if at <= end <= after:
            span[1] = word.start() + end - at
            break
        at = after + 1
    return min(span[0], len(text)), min(span[1], len(text))


def _passes(benchmark: DataFrame) -> list[list[tuple[int | None, str]]]:
    """Normalised items in groups whose text is bounded, each read by a job of its own."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = size // PASS_BYTES + 1
    group = F.pmod(F.xxhash64("item_id", "text"), F.lit(groups))
    for number in range(groups):
        rows = benchmark.where(F.col("text").isNotNull() & (group == number)).select("item_id", "text").collect()
        items = sorted({(r["item_id"], normalise(r["text"])) for r in rows}, key=lambda x: (x[0] is None, x))
        yield [(i, text) for i, text in items if text]


def find_leaks(documents: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """One row per document and benchmark item that it holds a copy of, with up to `rate` edits per character.

    Columns: doc_id, item_id, distance, budget, start and end (code points of the text) and length, the
    characters of the normalised item, by which a filter may weigh short ones. Of several
    copies the nearest is reported, the first of equal ones. Null and empty texts hold nothing;
    items that are null or have no letters or digits are not looked for. Those shorter than MIN_CHARS are
    found without edits, between word bounds. Repeated items give one row, repeated documents a row each.
    """
    ship(documents.sparkSession)
    spark = documents.sparkSession
    doc_kind = documents.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType
    item_kind = item_type.simpleString()
    schema = f"doc_id {doc_kind}, item_id {item_kind}, distance int, budget int, start int, end int, length int"
    names = ["doc_id", "item_id", "distance", "budget", "start", "end", "length"]

    def one_pass(items: list[tuple[int | None, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate)
            for rows, texts in slices(batches, "text"):
                ids, found = [], []
                for place, text in enumerate(texts):
                    text = text.as_py()
                    for item, distance, errors, start, end, size in matcher.find(normalise(text)):
                        ids.append(place)
                        found.append((item, distance, errors, *original_span(text, start, end), size))
                columns = [pa.array([f[i] for f in found]) for i in range(6)]
                kinds = [pa.int64() if item_kind == "bigint" else columns[0].type] + [pa.int32()] * 5
                doc_ids = rows.column("doc_id").take(pa.array(ids, pa.int64()))
                yield pa.RecordBatch.from_arrays([doc_ids, *(c.cast(k) for c, k in zip(columns, kinds))], names)

        return documents.select("doc_id", "text").mapInArrow(run, schema)

    return reduce(DataFrame.unionAll, [one_pass(items) for items in _passes(benchmark)])
