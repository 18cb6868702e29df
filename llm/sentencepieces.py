"""SentencePiece encoding and decoding on the tokenizers library.

The model file is parsed here; normaliser, word mark, piece scores and byte fallback are rebuilt as
a tokenizers object. Texts are cut before every run of word marks where no piece of the model spans
such a place; cuts that are new to a worker are encoded many in one sequence, on the task's own thread, and kept.
What comes out is held against the sentencepiece library, which is given whole texts, and decoded again.
"""

import hashlib
import os
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, cached_property, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from llm.common import ship, slices, utf8_bytes
from llm.training_order import Encoder

MARK = "▁"
# Text that is encoded at once: the libraries' lists and objects take many times its size.
SLICE_BYTES = 1 << 20
# Cuts that a worker keeps with their ids.
KNOWN_BYTES = 64 << 20
# Cuts that are given to the tokenizer as one sequence of words, and to the library as one text.
SEQUENCE_CUTS, TEXT_CUTS = 1024, 128
# Kinds of pieces in a model file: fixed values of the format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class PieceModel:
    """A parsed model file."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    mark_as_suffix: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protobuf message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(wire)
        if size is None:
            if wire != 2:
                raise ValueError("not a SentencePiece model")
            size = varint()
        yield key >> 3, data[at : at + size]
        at += size


def parse_model(data: bytes) -> PieceModel:
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for inner, x in _fields(value):
                if inner == 1:
                    text = x.decode("utf-8")
                elif inner == 2:
                    score = struct.unpack("<f", x)[0]
                elif inner == 3:
                    kind = x
            model.pieces.append((text, score, kind))
        elif number == 2:
            for inner, x in _fields(value):
                if inner == 3:
                    model.kind = x
                elif inner == 24:
                    model.mark_as_suffix = bool(x)
                elif inner == 35:
                    model.byte_fallback = bool(x)
        elif number == 3:
            for inner, x in _fields(value):
                if inner == 2:
                    model.charsmap = x
                elif inner == 3:
                    model.dummy_prefix = bool(x)
                elif inner == 4:
                    model.squeeze_spaces = bool(x)
                elif inner == 5:
                    model.escape_spaces = bool(x)
    unsupported = model.mark_as_suffix or not model.escape_spaces
    if unsupported or model.kind not in (UNIGRAM, BPE) or any(k == USER_DEFINED for *_, k in model.pieces):
        raise ValueError("model uses options that are not rebuilt here")
    return model


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Pairs that join into a piece, best piece first: the order in which BPE by scores joins them."""
    score = {text: s for text, s, kind in model.pieces if kind == NORMAL}
    pairs = []
    for text, value in score.items():
        for cut in range(1, len(text)):
            if text[:cut] in score and text[cut:] in score:
                pairs.append((-value, cut, text[:cut], text[cut:]))
    pairs.sort()
    return [(left, right) for _, _, left, right in pairs]


def separable(model: PieceModel) -> bool:
    """Whether no piece holds a word mark after another character, so that texts may be cut there."""
    return not any(
        b == MARK and a != MARK
        for text, _, kind in model.pieces
        if kind == NORMAL
        for a, b in zip(text, text[1:])
    )


def build_tokenizer(model: PieceModel, whole: bool = True) -> Tokenizer:
    """The model as a tokenizers object; `whole` for texts, else for cuts that are normalised already."""
    unknown = next(text for text, _, kind in model.pieces if kind == UNKNOWN)
    if model.kind == BPE:
        vocabulary = {text: i for i, (text, _, _) in enumerate(model.pieces)}
        core = models.BPE(
            vocab=vocabulary, merges=_merges(model), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback
        )
    else:
        number = next(i for i, (*_, kind) in enumerate(model.pieces) if kind == UNKNOWN)
        scored = [(text, score) for text, score, _ in model.pieces]
        core = models.Unigram(scored, unk_id=number, byte_fallback=model.byte_fallback)
    tokenizer = Tokenizer(core)
    if whole:
        steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.squeeze_spaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        steps += [normalizers.Prepend(MARK)] * model.dummy_prefix + [normalizers.Replace(" ", MARK)]
        tokenizer.normalizer = normalizers.Sequence(steps)
        if separable(model):
            tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    parts = [decoders.Replace(MARK, " ")] + [decoders.ByteFallback()] * model.byte_fallback + [decoders.Fuse()]
    if whole and model.dummy_prefix:
        parts.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(parts)
    return tokenizer


def _encode_cuts(words: list[str], tokenizer: Tokenizer, heads: np.ndarray | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The cuts, reordered, their ids one after another, and how many each has.

    A cut with one mark, at its front, has one piece that begins with a mark, its first; so many such cuts go
    into one sequence, and those pieces, told by `heads`, tell them apart. Other cuts go one by one, and all do should that fail.
    """
    plain = [w for w in words if w[0] == MARK and w[1:2] != MARK] if heads is not None else []
    parts = [plain[i : i + SEQUENCE_CUTS] for i in range(0, len(plain), SEQUENCE_CUTS)]
    found = tokenizer.encode_batch_fast(parts, is_pretokenized=True, add_special_tokens=False)
    ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.int32)
    starts = np.flatnonzero(heads[ids]) if plain else np.zeros(0, np.int64)
    if len(starts) != len(plain) or plain and starts[0]:
        return _encode_cuts(words, tokenizer, None)
    others = [w for w in words if w[0] != MARK or w[1:2] == MARK] if heads is not None else words
    single = [e.ids for e in tokenizer.encode_batch_fast(others, add_special_tokens=False)]
    sizes = np.append(np.diff(np.append(starts, len(ids))), np.fromiter(map(len, single), np.int64, len(single)))
    return plain + others, np.append(ids, np.fromiter(chain.from_iterable(single), np.int32)), sizes


class KnownCuts:
    """Ids of cuts that were encoded before, kept up to a number of bytes; then begun anew."""

    def __init__(self, most_bytes: int = 0):
        self.most = most_bytes or KNOWN_BYTES
        self._begin()

    def _begin(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.starts, self.used, self.held = np.zeros(1 << 16, np.int32), [np.zeros(1, np.int64)], 0, 0

    def ids(self, words: list[str], tokenizer: Tokenizer, heads: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of many cuts in one array, and where those of each given cut begin and end.

        `heads` says of every piece whether it begins with the word mark; without it cuts are encoded one by one.
        """
        if self.held > self.most:
            self._begin()
        if new := [w for w in words if w not in self.place]:
            new, found, sizes = _encode_cuts(new, tokenizer, heads)
            ends = np.cumsum(sizes) + self.used
            if ends[-1] > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(max(ends[-1] - len(self.flat), len(self.flat)), np.int32)])
            self.flat[self.used : ends[-1]] = found
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            # A dictionary's entry, a string's head and a number besides the text and the ids themselves.
            self.held += sum(map(len, new)) + 4 * int(ends[-1] - self.used) + 200 * len(new)
            self.used = int(ends[-1])
            self.starts = [np.concatenate([*self.starts, ends])]
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        return self.flat, self.starts[0][at], self.starts[0][at + 1]


class Codec:
    """Encoder and decoder of one model, with the library it is held against; each is built when it is first asked."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self._data = file.read()
        self.model = parse_model(self._data)
        self.by_cut = separable(self.model) and not self.model.charsmap and not self.model.squeeze_spaces
        self._known = KnownCuts()
        self._heads = np.array([text.startswith(MARK) for text, *_ in self.model.pieces], bool)
        # A task has one core: threads of its own would take those of other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

    @cached_property
    def texts(self) -> Tokenizer:
        """For whole texts."""
        return build_tokenizer(self.model)

    @cached_property
    def cuts(self) -> Tokenizer:
        """For cuts that are normalised already."""
        return build_tokenizer(self.model, whole=False)

    @cached_property
    def library(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self._data)

    @cached_property
    def _piece_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """What the pieces decode to, one after another, and where each begins."""
        parts = []
        for text, _, kind in self.model.pieces:
            plain = bytes([int(text[1:-1], 16)]) if kind == BYTE else text.replace(MARK, " ").encode("utf-8", "surrogatepass")
            parts.append(b"" if kind == CONTROL else plain)
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])

    def _cuts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Distinct cuts, the cut at every place, and the bounds of texts in these."""
        filled = pc.greater(pc.binary_length(texts), 0)
        marked = pc.replace_substring(texts, " ", MARK)
        if self.model.dummy_prefix:
            edge = [pa.scalar(x, pa.large_string()) for x in (MARK, "")]
            marked = pc.if_else(filled, pc.binary_join_element_wise(edge[0], marked, edge[1]), marked)
        content, offsets = utf8_bytes(marked)
        mark = MARK.encode()
        starts = np.zeros(len(content) + 1, bool)
        if len(content) > 2:
            here = (content[:-2] == mark[0]) & (content[1:-1] == mark[1]) & (content[2:] == mark[2])
            starts[: len(here)] = here
            starts[3 : len(here)] &= ~here[:-3]
        starts[offsets[:-1]] = True
        at = np.flatnonzero(starts[: len(content)])
        cuts = pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(np.append(at, len(content)).astype(np.int64)), pa.py_buffer(content)
        ).dictionary_encode()
        place = cuts.indices.to_numpy().astype(np.int64)
        return cuts.dictionary, place, np.searchsorted(at, offsets)

    @staticmethod
    def _laid_out(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, place: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after another, and their bounds, from those of the distinct cuts."""
        first, n = starts[place], (ends - starts)[place]
        ids = flat[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return ids, np.concatenate([[0], np.cumsum(n)])[bounds]

    def _found(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after another, and their bounds, from the ids of distinct cuts."""
        words, place, bounds = self._cuts(texts)
        return self._laid_out(*self._known.ids(words.to_pylist(), self.cuts, self._heads), place, bounds)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after another, and their bounds, without a comparison."""
        if self.by_cut:
            return self._found(texts)
        rows = texts.to_pylist()
        found = [e.ids for e in self.texts.encode_batch_fast(rows, add_special_tokens=False)]
        found = [x if r else [] for x, r in zip(found, rows)]
        return np.array([i for x in found for i in x], np.int32), np.cumsum([0, *map(len, found)])

    @cached_property
    def _mark_id(self) -> int | None:
        """The piece that is a mark alone, where the library's ids of a text are those of its cuts; else None.

        In BPE by scores joins at one place do not depend on others, and with byte fallback no ids are merged afterwards.
        """
        plain = all(kind in (NORMAL, UNKNOWN, CONTROL, BYTE) for *_, kind in self.model.pieces)
        if not (self.by_cut and plain and self.model.kind == BPE and self.model.byte_fallback and self.model.dummy_prefix):
            return None
        return next((i for i, (text, _, kind) in enumerate(self.model.pieces) if text == MARK and kind == NORMAL), None)

    def library_cut_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As library_ids, but the library is given each distinct cut once, many in one text.

        A cut with one mark, at its front, has one piece that begins with a mark, its first; by those pieces the
        ids are dealt to the cuts again. Cuts with several marks are texts of their own. Should that fail, or the model not
        allow it, the library is given the whole texts.
        """
        if self._mark_id is None:
            return self.library_ids(texts)
        words, place, bounds = self._cuts(texts)
        content, at = utf8_bytes(words)
        sizes, second = np.diff(at), np.append(content, np.zeros(6, np.uint8))
        many = np.logical_and.reduce([second[at[:-1] + 3 + i] == b for i, b in enumerate(MARK.encode())]) & (sizes > 3)
        plain = ~many & (sizes > 3)
        data, ends = utf8_bytes(words.filter(pa.array(plain)))
        data = data.tobytes()
        steps = np.append(ends[:-1:TEXT_CUTS], ends[-1]).tolist()
        # The library puts the first mark in front itself.
        joined = [data[a:b].decode().replace(MARK, " ")[1:] for a, b in zip(steps, steps[1:])]
        apart = [w.replace(MARK, " ")[1:] for w in words.filter(pa.array(many)).to_pylist()]
        flat, stops = array("i"), []
        for found in self.library.encode(joined + apart, num_threads=1):
            flat.fromlist(found)
            stops.append(len(flat))
        flat.append(self._mark_id)
        ids = np.array(flat, np.int32)
        shared = stops[len(joined) - 1] if joined else 0
        heads = np.flatnonzero(self._heads[ids[:shared]])
        if len(heads) != plain.sum() or len(heads) and heads[0]:
            return self.library_ids(texts)
        # A cut that is a mark alone has the last id.
        starts, stop = np.full(len(words), len(ids) - 1), np.full(len(words), len(ids))
        starts[plain], stop[plain] = heads, np.append(heads[1:], shared)[: len(heads)]
        starts[many], stop[many] = [shared, *stops[len(joined) : -1]][: len(apart)], stops[len(joined) :]
        return self._laid_out(ids, starts, stop, place, bounds)

    def library_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after another, and their bounds, as the library gives them."""
        flat, bounds = array("i"), [0]
        for found in self.library.encode(texts.to_pylist(), num_threads=1):
            flat.fromlist(found)
            bounds.append(len(flat))
        return np.array(flat, np.int32), np.array(bounds, np.int64)

    def encode(self, texts: pa.Array) -> "Encoded":
        """Ids of every whole text, compared with the library's for the whole text, and decoded again."""
        if not self.by_cut:
            return self._encode_whole(texts)
        ids, ends = self._found(texts)
        return Encoded(ids, ends, self._equal(ids, ends, *self.library_ids(texts)), self._decodes(ids, ends, texts))

    @staticmethod
    def _equal(ids: np.ndarray, ends: np.ndarray, expected: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether texts have the same ids in both."""
        same = np.diff(ends) == np.diff(bounds)
        if same.all():
            wrong = np.concatenate([[0], np.cumsum(ids != expected)])[ends]
            return np.diff(wrong) == 0
        spans = zip(same, ends, ends[1:], bounds, bounds[1:])
        return np.array([bool(x and (ids[a:b] == expected[c:d]).all()) for x, a, b, c, d in spans], bool)

    def _decodes(self, ids: np.ndarray, ends: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Whether the ids of every text decode to its bytes; the mark put in front of a text is taken off."""
        content, starts = self._piece_bytes
        n = np.diff(starts)[ids]
        flat = content[np.repeat(starts[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes()
        at = np.concatenate([[0], np.cumsum(n)])[ends].tolist()
        plain, offsets = utf8_bytes(texts)
        plain, offsets = plain.tobytes(), offsets.tolist()
        lead = b" " if self.model.dummy_prefix else b""
        found = []
        for a, b, c, d in zip(at, at[1:], offsets, offsets[1:]):
            found.append(flat[a:b] == (lead + plain[c:d] if d > c else b""))
        return np.array(found, bool)

    def _encode_whole(self, texts: pa.Array) -> "Encoded":
        rows = texts.to_pylist()
        found = [e.ids for e in self.texts.encode_batch_fast(rows, add_special_tokens=False)]
        found = [x if r else [] for x, r in zip(found, rows)]
        expected = self.library.encode(rows, num_threads=1)
        back = self.texts.decode_batch(found, skip_special_tokens=False)
        sizes = np.array([len(x) for x in found], np.int64)
        ids = np.array([i for x in found for i in x], np.int32)
        same = np.array([a == b for a, b in zip(found, expected)], bool)
        whole = np.array([a == b for a, b in zip(rows, back)], bool)
        return Encoded(ids, np.concatenate([[0], np.cumsum(sizes)]), same, whole)

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of id lists."""
        return self.texts.decode_batch(ids, skip_special_tokens=False)


@dataclass
class Encoded:
    """Ids of texts one after another, their bounds, and per text whether the libraries agree and ids decode to it."""

    ids: np.ndarray
    bounds: np.ndarray
    parity: np.ndarray
    round_trip: np.ndarray


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def _ids(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return codec(path).library_cut_ids(texts)


def id_encoder(path: str) -> Encoder:
    """The model as an encoder of training sequences; ids take two bytes, or four in a large vocabulary."""
    with open(path, "rb") as file:
        pieces = len(parse_model(file.read()).pieces)
    return Encoder(partial(_ids, path), 2 if pieces <= 1 << 16 else 4)


def encode_documents(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, n_tokens, parity and round_trip of every document, row for row.

    `path` names a model file that executors reach. No begin or end ids are added. Null and empty
    texts have no ids. `parity` says that the sentencepiece library gives the same ids, `round_trip` that the
    ids decode to the text; a text that holds the word mark itself decodes with spaces in its place.
    """
    ship(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text", SLICE_BYTES):
            found = codec(path).encode(texts)
            ids = pa.ListArray.from_arrays(pa.array(found.bounds, pa.int32()), pa.array(found.ids, pa.int32()))
            columns = [rows.column("doc_id"), ids, pa.array(np.diff(found.bounds), pa.int64())]
            columns += [pa.array(found.parity), pa.array(found.round_trip)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_tokens", "parity", "round_trip"])

    schema = f"doc_id {kind}, ids array<int>, n_tokens bigint, parity boolean, round_trip boolean"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def encode_digests(documents: DataFrame, path: str) -> DataFrame:
    """As encode_documents, with the SHA-256 of the ids as little-endian int32 in place of the ids."""
    ship(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text", SLICE_BYTES):
            found = codec(path).encode(texts)
            data, ends = memoryview(found.ids.astype("<i4")).cast("B"), (found.bounds * 4).tolist()
            digests = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]
            columns = [rows.column("doc_id"), pa.array(np.diff(found.bounds), pa.int64()), pa.array(digests, pa.string())]
            columns += [pa.array(found.parity), pa.array(found.round_trip)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "parity", "round_trip"])

    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, parity boolean, round_trip boolean"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids give an empty text."""
    ship(encoded.sparkSession)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = codec(path).decode([x or [] for x in rows.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", F.col("ids")).mapInArrow(run, f"doc_id {kind}, text string")
