"""Token counts from a compiled tokenizer: finite-state transducers whose transitions carry counts.

A byte-level BPE tokenizer is compiled into two deterministic machines.

The first cuts text into words. It reads character classes; a transition says whether a word begins
at the character read or at the one before. Text is cut into equal chunks, each chunk becomes a map
from state to state, and the maps are composed by a parallel prefix scan, so that every chunk knows
its first state and all chunks run side by side.

The second counts the tokens of a word. After each byte its state holds every place where a token
may still be under way: the node in the token trie, the token that ended there, and how many tokens
the text up to there has less than the text so far. BPE gives a prefix one last token only, that of
the candidates which may follow the token before it, so a transition is determined by state and
byte, and carries by how much the count grows. States are compiled when they are first met.
"""

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import ship, slices, utf8_bytes

LIMIT = 512
CHUNK = 64
# Compiled states a worker keeps; beyond this it starts compiling anew.
MAX_STATES = 300_000

# Character classes. TSMD, E, R, V, LL are the letters of the contractions 's 't 'm 'd 're 've 'll.
_CLASSES = ["L", "TSMD", "E", "R", "V", "LL", "N", "SPACE", "WHITE", "QUOTE", "OTHER", "END"]
_STATES = ["START", "L", "N", "OTHER", "SPACE", "WHITE", "QUOTE", "DONE", "R", "V", "LL"]
_HERE, _BEFORE = 1, 2


def _word_machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and word starts (bits: at this character, at the one before) by state and class."""
    letters = {"L", "TSMD", "E", "R", "V", "LL"}
    kind = {**dict.fromkeys(letters, "L"), "N": "N", "OTHER": "OTHER", "QUOTE": "OTHER"}

    def fresh(symbol: str) -> str:
        """State after a word's first character."""
        if symbol == "QUOTE":
            return "QUOTE"
        return kind.get(symbol, symbol)

    def step(state: str, symbol: str) -> tuple[str, int]:
        if state in ("R", "V", "LL"):
            if symbol == {"R": "E", "V": "E", "LL": "LL"}[state]:
                return "DONE", 0
            after, starts = step("L", symbol)
            return after, starts | _BEFORE
        if symbol == "END":
            return "START", _HERE
        if state in ("SPACE", "WHITE"):
            if symbol in ("SPACE", "WHITE"):
                return symbol, 0
            if state == "SPACE":
                return kind[symbol], _BEFORE
            return fresh(symbol), _BEFORE | _HERE
        if state == "QUOTE":
            if symbol == "TSMD":
                return "DONE", 0
            if symbol in ("R", "V", "LL"):
                return symbol, 0
            if symbol in ("OTHER", "QUOTE"):
                return "OTHER", 0
        if state in ("L", "N", "OTHER") and kind.get(symbol) == state:
            return state, 0
        return fresh(symbol), _HERE

    table = np.zeros((len(_STATES), len(_CLASSES)), np.uint8)
    starts = np.zeros_like(table)
    for i, state in enumerate(_STATES):
        for j, symbol in enumerate(_CLASSES):
            after, starts[i, j] = step(state, symbol)
            table[i, j] = _STATES.index(after)
    return table, starts


@cache
def _machine() -> tuple[np.ndarray, np.ndarray]:
    return _word_machine()


@cache
def char_classes() -> np.ndarray:
    """Class of every code point."""
    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    where = np.frombuffer(points.encode("utf-32-le"), np.uint32)
    table = np.full(0x110000, _CLASSES.index("OTHER"), np.uint8)
    for name, pattern in (("L", r"\p{L}"), ("N", r"\p{N}"), ("WHITE", r"\s")):
        found = [m.start() for m in regex.finditer(pattern, points)]
        table[where[found]] = _CLASSES.index(name)
    for name, chars in (("TSMD", "tsmd"), ("E", "e"), ("R", "r"), ("V", "v"), ("LL", "l"), ("SPACE", " "), ("QUOTE", "'")):
        for char in chars:
            table[ord(char)] = _CLASSES.index(name)
    return table


def start_states(maps: np.ndarray) -> np.ndarray:
    """First state of every chunk, by a prefix scan that composes the chunks' state maps."""
    scanned, reach = maps, 1
    while reach < len(maps):
        joined = scanned.copy()
        joined[reach:] = np.take_along_axis(scanned[reach:], scanned[:-reach], axis=1)
        scanned, reach = joined, reach * 2
    return np.concatenate([[0], scanned[:-1, 0]]).astype(np.uint8)


def word_starts(symbols: np.ndarray) -> np.ndarray:
    """Whether a word starts at each character, for classes of texts that each close with END."""
    table, starts = _machine()
    width = table.shape[1]
    n = -(-len(symbols) // CHUNK)
    padded = np.full(n * CHUNK, width - 1, np.uint8)
    padded[: len(symbols)] = symbols
    columns = np.ascontiguousarray(padded.reshape(n, CHUNK).T)
    flat, bits = (table.astype(np.intp) * width).ravel(), starts.ravel()
    maps = np.repeat(np.arange(len(table))[:, None] * width, n, axis=1)
    for column in columns:
        maps += column
        np.take(flat, maps, out=maps, mode="clip")
    state = start_states(np.ascontiguousarray((maps // width).T)).astype(np.intp) * width
    marks = np.empty((CHUNK, n), np.uint8)
    for j, column in enumerate(columns):
        at = state + column
        marks[j] = bits[at]
        state = flat[at]
    marks = np.ascontiguousarray(marks.T).ravel()
    found = (marks & _HERE).astype(bool)
    found[:-1] |= (marks[1:] & _BEFORE).astype(bool)
    return found[: len(symbols)]


class TokenCounter:
    """The compiled machine that counts the tokens of a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        byte_level = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        plain = not (model["dropout"] or model["continuing_subword_prefix"] or model["end_of_word_suffix"])
        added = spec["added_tokens"]
        simple = not any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in added)
        if model["type"] != "BPE" or spec["normalizer"] or not (byte_level and plain and simple) or model["ignore_merges"]:
            raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
        self.specials = sorted((a["content"] for a in added), key=len, reverse=True)
        to_byte = {char: byte for byte, char in enumerate(_byte_alphabet())}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocabulary = model["vocab"]
        self.ranks = {(vocabulary[a], vocabulary[b]): rank for rank, (a, b) in enumerate(merges)}
        self.made = {
            vocabulary[a + b]: (rank, vocabulary[a], vocabulary[b]) for rank, (a, b) in enumerate(merges)
        }
        self.right: dict[int, list] = {}
        self.left: dict[int, list] = {}
        self.tokens = {i: bytes(to_byte[c] for c in text) for text, i in vocabulary.items() if all(c in to_byte for c in text)}
        self.edges: dict[tuple[int, int], int] = {}
        self.named: dict[int, int] = {}
        nodes = 1
        for i, content in self.tokens.items():
            node = 0
            for byte in content:
                if (node, byte) not in self.edges:
                    self.edges[node, byte] = nodes
                    nodes += 1
                node = self.edges[node, byte]
            self.named[node] = i
        self.inner = {node for node, _ in self.edges}
        self.fits: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.states: dict[tuple, int] = {((0, -1, 0),): 0}
        self.entries: list[tuple] = [((0, -1, 0),)]
        self.moves: list[dict[int, tuple[int, int]]] = [{}]

    def _spine(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """Pieces that stood at one edge of a token while it was built, with the ranks between which they did."""
        spine, gone = [], len(self.ranks)
        while token in self.made:
            rank, *pair = self.made[token]
            spine.append((token, rank, gone))
            token, gone = pair[side], rank
        return [*spine, (token, -1, gone)]

    def _may_follow(self, first: int, second: int) -> bool:
        """Whether the two tokens side by side stay as they are when their text is encoded.

        Merges go by rank, so they stay unless two pieces at the common edge stood there at the
        same time and their merge came up before either was merged away; of equal merges the left one is first.
        """
        key = first, second
        if key not in self.fits:
            for token, side, spines in ((first, 1, self.right), (second, 0, self.left)):
                if token not in spines:
                    spines[token] = self._spine(token, side)
            self.fits[key] = not any(
                max(since_a, since_b) < rank < until_a and rank <= until_b
                for a, since_a, until_a in self.right[first]
                for b, since_b, until_b in self.left[second]
                if (rank := self.ranks.get((a, b), -1)) >= 0
            )
        return self.fits[key]

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        alive, last, grown = [], None, 0
        for node, ended, less in self.entries[state]:
            child = self.edges.get((node, byte))
            if child is None:
                continue
            token = self.named.get(child)
            if last is None and token is not None and (ended < 0 or self._may_follow(ended, token)):
                last, grown = token, less + 1
            if child in self.inner:
                alive.append((child, ended, less))
        if last is None:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        entry = (*((node, ended, less - grown) for node, ended, less in alive), (0, last, 0))
        after = self.states.setdefault(entry, len(self.entries))
        if after == len(self.entries):
            self.entries.append(entry)
            self.moves.append({})
        self.moves[state][byte] = after, grown
        return after, grown

    def count(self, words: pa.Array) -> np.ndarray:
        """Tokens of each word."""
        if len(self.entries) > MAX_STATES:
            self._forget()
        content, offsets = utf8_bytes(words)
        content, offsets = content.tobytes(), offsets.tolist()
        counts = np.empty(len(words), np.int64)
        moves, compile_ = self.moves, self._compile
        for i in range(len(words)):
            state = total = 0
            for byte in content[offsets[i] : offsets[i + 1]]:
                step = moves[state].get(byte)
                if step is None:
                    step = compile_(state, byte)
                state, grown = step
                total += grown
            counts[i] = total
        return counts


def _byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


@cache
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def _cut_specials(texts: pa.Array, specials: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Pieces between special strings, the text each is from, and the special strings of each text."""
    found = np.zeros(len(texts), np.int64)
    present = pa.array(np.zeros(len(texts), bool))
    for special in specials:
        present = pc.or_(present, pc.match_substring(texts, special))
    hit = np.flatnonzero(present.to_numpy(zero_copy_only=False))
    if not len(hit):
        return texts, np.arange(len(texts)), found
    pattern = regex.compile("|".join(map(regex.escape, specials)))
    rows, owner, done = texts.to_pylist(), [], 0
    pieces: list[str] = []
    for i in hit:
        pieces += rows[done:i]
        owner += range(done, i)
        parts = pattern.split(rows[i])
        pieces += parts
        owner += [i] * len(parts)
        found[i], done = len(parts) - 1, i + 1
    pieces += rows[done:]
    owner += range(done, len(rows))
    return pa.array(pieces, pa.large_string()), np.array(owner, np.int64), found


def count_tokens(path: str, texts: pa.Array) -> np.ndarray:
    """Tokens of every whole text."""
    machine = counter(path)
    pieces, owner, total = _cut_specials(texts, machine.specials)
    content, offsets = utf8_bytes(pieces)
    leads = (content & 0xC0) != 0x80
    chars = np.frombuffer(content.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    ends = np.concatenate([[0], np.cumsum(leads)])[offsets[1:]]
    place = ends + np.arange(len(ends))
    symbols = np.empty(len(chars) + len(ends), np.uint8)
    real = np.ones(len(symbols), bool)
    real[place] = False
    symbols[real] = char_classes()[chars]
    symbols[~real] = len(_CLASSES) - 1
    starts = word_starts(symbols)[real]
    at = np.flatnonzero(leads)[starts]
    words = pa.LargeStringArray.from_buffers(
        len(at), pa.py_buffer(np.append(at, len(content)).astype(np.int64)), pa.py_buffer(content)
    )
    coded = words.dictionary_encode()
    counts = machine.count(coded.dictionary.cast(pa.large_string()))[coded.indices.to_numpy()]
    running = np.concatenate([[0], np.cumsum(counts)])
    first = np.searchsorted(at, offsets)
    per_piece = running[first[1:]] - running[first[:-1]]
    np.add.at(total, owner, per_piece)
    return total


def count_documents(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document, row for row.

    Counts are those of the tokenizer file at `path`, which executors must reach under that name,
    without begin, end or padding; special strings in a text are one token each. Null texts are empty.
    """
    ship(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            sizes = pc.binary_length(texts).cast(pa.int64())
            counts = pa.array(count_tokens(path, texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), sizes, counts], ["doc_id", "n_bytes", "n_tokens"]
            )

    counted = documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
