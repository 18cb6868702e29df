"""Subword tokens: words cut greedily into the longest pieces of a vocabulary, found in a trie.

A tokenizer is a function from a text column to an array column, like `tokens`; windows and scoring take either.
"""

from collections.abc import Callable, Iterable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.tokens import tokens

# Mark of a piece that does not begin a word, and the token of a word that the pieces do not cover.
INSIDE, UNKNOWN = "##", "[UNK]"
# Largest vocabulary, by its text, that is sent along with a job.
VOCABULARY_BYTES = 64 << 20

Tokenizer = Callable[[Column], Column]


class Trie:
    """Pieces by their characters: those that begin words, and those inside of words."""

    def __init__(self, pieces: Iterable[str]):
        self.heads: dict = {}
        self.tails: dict = {}
        for piece in pieces:
            inside = piece.startswith(INSIDE) and len(piece) > len(INSIDE)
            node = self.tails if inside else self.heads
            for char in piece[len(INSIDE) :] if inside else piece:
                node = node.setdefault(char, {})
            node[""] = piece

    def cut(self, word: str) -> list[str]:
        """The pieces of a word, each the longest that fits; one unknown token if some place fits none."""
        found, at = [], 0
        while at < len(word):
            node, piece, end, here = self.tails if at else self.heads, None, at, at
            while here < len(word) and (node := node.get(word[here])) is not None:
                here += 1
                if "" in node:
                    piece, end = node[""], here
            if piece is None:
                return [UNKNOWN]
            found.append(piece)
            at = end
        return found


def cut_words(lists: pa.Array, trie: Trie) -> pa.Array:
    """Lists of words as lists of pieces; each distinct word of the batch is cut once."""
    words = lists.flatten().dictionary_encode()
    pieces = pa.array([trie.cut(w) for w in words.dictionary.to_pylist()], pa.list_(pa.string()))
    placed = pieces.take(words.indices)
    ends = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(pc.list_value_length(placed)).cast(pa.int64())])
    sizes = pc.fill_null(pc.list_value_length(lists), 0)
    bounds = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(sizes).cast(pa.int64())])
    offsets = ends.take(bounds).cast(pa.int32())
    return pa.ListArray.from_arrays(offsets, placed.flatten(), mask=lists.is_null())


def subword_tokenizer(vocabulary: DataFrame, most_bytes: int = VOCABULARY_BYTES) -> Tokenizer:
    """A tokenizer from a table of pieces (column `piece`), which is measured before it is fetched.

    Words are those of `tokens`, in small letters; nulls and empty pieces of the table count nothing.
    """
    pieces = vocabulary.where(F.col("piece") != "").select("piece").distinct()
    size = pieces.agg(F.coalesce(F.sum(F.octet_length("piece")), F.lit(0))).first()[0]
    if size > most_bytes:
        raise ValueError(f"a vocabulary of {size} bytes is no vocabulary")
    listed = pieces.toArrow()["piece"].to_pylist()
    tries: list[Trie] = []

    @F.arrow_udf("array<string>")
    def cut(lists: pa.Array) -> pa.Array:
        if not tries:
            tries.append(Trie(listed))
        return cut_words(lists, tries[0])

    return lambda text: cut(tokens(text))
