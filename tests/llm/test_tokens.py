import random

import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
from tokenizers import Tokenizer  # noqa: E402

from llm import sentencepieces, token_counts  # noqa: E402

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BITS = [
    "'s", "'", "'re", "'r", "'ve", "'ll", "'l", "'t", " ", "  ", "\n", "\t", "a", "b", "ing", "the", "1", "23", "!",
    "--", "é", "　", "<|endoftext|>", "<|endof", "𝄞", "\r\n", "'S", "e", "'m", "'d", "日本", "\x00", "</s>", "<0x41>",
]


def random_texts(n):
    rng = random.Random(3)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


LONG = ["", " ", "a" * 5000, " " * 3000, "ab" * 4000, "\n" * 999, "'" * 500, "the" * 3000]


def test_counts_equal_the_library():
    texts = random_texts(8000) + LONG
    counted = token_counts.count_tokens(BYTES, pa.array(texts, pa.large_string()))
    found = Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)
    assert counted.tolist() == [len(e) for e in found]


def test_character_classes_equal_the_library():
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}a 1{c}1 !{c}! {c}{c} {c} x" for c in points]
    counted = token_counts.count_tokens(BYTES, pa.array(texts, pa.large_string()))
    found = Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)
    assert [p for p, a, b in zip(points, counted, found) if a != len(b)] == []


def test_counts_of_frames(spark, frame):
    rows = [(1, "the cat"), (1, "the cat"), (None, None), (3, ""), (4, "é " * 600)]
    out = token_counts.count_documents(frame(rows), BYTES).collect()
    library = Tokenizer.from_file(BYTES)
    expected = [(i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 512) for i, t in rows]
    assert sorted(map(tuple, out), key=repr) == sorted(expected, key=repr)
    assert token_counts.count_documents(frame([]), BYTES).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.TokenCounter(public_tokenizers.path("word_bpe_49k.json"))


def test_pieces_equal_the_library():
    codec, library = sentencepieces.codec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = random_texts(6000) + LONG
    found, expected = codec.encode(pa.array(texts, pa.large_string())), library.encode(texts)
    assert [found.ids[a:b].tolist() for a, b in zip(found.bounds, found.bounds[1:])] == expected
    assert found.parity.all() and found.round_trip.all()
    whole = codec._encode_whole(pa.array(texts, pa.large_string()))
    assert [whole.ids[a:b].tolist() for a, b in zip(whole.bounds, whole.bounds[1:])] == expected
    assert codec.decode(expected) == texts


def test_pieces_of_frames(spark, frame):
    rows = [(1, "the cat"), (1, "the cat"), (None, None), (3, ""), (4, "日本 " * 600)]
    encoded = sentencepieces.encode_documents(frame(rows), PIECES)
    assert all(r["parity"] and r["round_trip"] for r in encoded.collect())
    decoded = sentencepieces.decode_documents(encoded, PIECES)
    assert sorted(map(tuple, decoded.collect()), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert sentencepieces.encode_digests(frame([]), PIECES).count() == 0


def test_unigram_models_are_rebuilt(tmp_path):
    """A small unigram model, written as a model file field by field."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def message(number, body):
        return varint(number << 3 | 2) + varint(len(body)) + body

    import struct

    scored = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), ("▁", -3.0, 1), ("a", -4.0, 1), ("b", -4.0, 1)]
    scored += [("ab", -5.0, 1), ("▁ab", -6.0, 1), ("ba", -6.5, 1)]
    data = b"".join(
        message(1, message(1, t.encode()) + b"\x15" + struct.pack("<f", s) + b"\x18" + varint(k)) for t, s, k in scored
    )
    data += message(2, b"\x18\x01") + message(3, message(1, b"identity") + b"\x18\x01\x20\x00")
    path = tmp_path / "small.model"
    path.write_bytes(data)
    codec, library = sentencepieces.Codec(str(path)), sentencepiece.SentencePieceProcessor(model_proto=data)
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 12))) for _ in range(500)]
    found = codec.encode(pa.array(texts, pa.large_string()))
    assert [found.ids[a:b].tolist() for a, b in zip(found.bounds, found.bounds[1:])] == library.encode(texts)


def test_known_cuts_are_bounded_and_change_nothing():
    codec = sentencepieces.Codec(PIECES)
    codec._known = sentencepieces.KnownCuts(2000)
    fresh = sentencepieces.Codec(PIECES)
    for i in range(30):
        texts = pa.array([f"word{i} again {i * 7919} é▁x  two", "again word1", "", " "], pa.large_string())
        for ours, plain in zip(codec.ids(texts), fresh.ids(texts)):
            assert ours.tolist() == plain.tolist()
        assert len(codec._known.place) < 40
    assert "texts" not in codec.__dict__ and "library" not in codec.__dict__


def test_new_cuts_are_encoded_as_sequences(monkeypatch):
    """Many new cuts are a few sequences for the tokenizer, and each has the ids it has alone."""
    codec, sizes = sentencepieces.Codec(PIECES), []

    class Spy:
        def encode_batch_fast(self, rows, **options):
            sizes.append(len(rows))
            return codec.cuts.encode_batch_fast(rows, **options)

    words = [f"▁w{i * 7919}é日" for i in range(3000)] + ["▁▁▁two", "none", "▁", "▁\U0001f600", "▁\x00"]
    flat, starts, ends = sentencepieces.KnownCuts().ids(words, Spy(), codec._heads)
    alone = [e.ids for e in codec.cuts.encode_batch_fast(words, add_special_tokens=False)]
    assert [flat[a:b].tolist() for a, b in zip(starts, ends)] == alone
    assert sum(sizes) < 10


def test_whole_texts_are_compared_and_decoded():
    codec = sentencepieces.Codec(PIECES)
    texts = pa.array(["plain text", "a▁b", "", "tab\tünï\u0000 日本 \U0001f600", "  two  "], pa.large_string())
    found = codec.encode(texts)
    assert found.parity.tolist() == [True] * 5 and found.round_trip.tolist() == [True, False, True, True, True]
    codec._known.ids(["▁plain"], codec.cuts)
    codec._known.flat[:] = 7
    assert not codec.encode(texts).parity[0] and not codec.encode(texts).round_trip[0]
