"""Words of many texts at once, and hashed n-grams of their distinct words, as numpy arrays."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from llm.common import mix, utf8_bytes

_PRIME = np.uint64(0x100000001B3)


@dataclass
class Words:
    """Words of a piece: their places in `distinct`, and where each text starts in `ids`."""

    ids: np.ndarray
    starts: np.ndarray
    distinct: pa.Array


def split_words(texts: pa.Array, lower: bool = False, empty_word: bool = False) -> Words:
    """Words between ASCII white space. `empty_word` gives texts without words one empty word."""
    if lower:
        texts = pc.utf8_lower(texts)
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    flat = lists.flatten()
    starts = lists.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0]
    if not empty_word:
        filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
        kept = np.concatenate([[0], np.cumsum(filled)])
        starts, flat = kept[starts], flat.filter(pa.array(filled))
    coded = flat.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Words(ids, starts, coded.dictionary.cast(pa.large_string()))


def word_hashes(words: pa.Array) -> np.ndarray:
    """One 64-bit hash per word."""
    content, offsets = utf8_bytes(words)
    return hash_spans(content.astype(np.uint64) + np.uint64(1), offsets)


def hash_spans(symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of symbols: a polynomial taken from one running sum, then mixed."""
    with np.errstate(over="ignore"):
        longest = int(np.diff(offsets).max(initial=0))
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest, _PRIME, np.uint64)]))
        place = np.arange(len(symbols)) - np.repeat(offsets[:-1], np.diff(offsets))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(symbols) * powers[place])])
        return mix(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64))


def char_ngrams(words: pa.Array, sizes: range, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of `<word>`: the word each belongs to, in order of n, and its bucket."""
    edge = [pa.scalar(mark, pa.large_string()) for mark in ("<", ">", "")]
    text = pc.binary_join_element_wise(edge[0], words, edge[1], edge[2])
    lengths = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = "".join(text.to_pylist())
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    owners, found = [], []
    with np.errstate(over="ignore"):
        value = np.zeros(len(chars), np.uint64)
        for n in range(1, sizes.stop):
            if n > len(chars):
                break
            last = len(chars) - n + 1
            value = (value[:last] * _PRIME) + mix(chars[n - 1 :])
            if n in sizes:
                whole = owner[:last] == owner[n - 1 :]
                owners.append(owner[:last][whole])
                found.append((mix(value[whole] + np.uint64(n)) % np.uint64(buckets)).astype(np.int64))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(found)


# ASCII other than letters becomes a space, A-Z become small; all other bytes stay.
_LETTERS = bytes(
    ord(" ") if b < 128 and not chr(b).isalpha() else ord(chr(b).lower()) if b < 128 else b for b in range(256)
)


def letter_runs(texts: pa.Array) -> Words:
    """Runs of letters and non-ASCII characters of every text, with A-Z made small."""
    content, offsets = utf8_bytes(texts)
    content = np.frombuffer(content.tobytes().translate(_LETTERS), np.uint8)
    inside = content != ord(" ")
    begins = inside.copy()
    if len(content) > 1:
        begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    at = np.flatnonzero(begins)
    kept = np.cumsum(inside) - 1
    ends = np.append(kept[at], inside.sum()).astype(np.int64)
    runs = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(content[inside]))
    coded = runs.dictionary_encode()
    return Words(coded.indices.to_numpy().astype(np.int64), np.searchsorted(at, offsets), coded.dictionary)
