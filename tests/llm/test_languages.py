"""Language mixtures: plain loops, held-out rows, mixed texts and edges."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from llm import language_mixture as lm

SCHEMA = "doc_id bigint, text string, lang string, source string, languages string, shares string"
SYLLABLES = {
    "xa": ["ba", "do", "mi", "ta", "re"],
    "xb": ["sch", "ung", "ei", "über", "zt"],
    "xc": ["ção", "lh", "nh", "os", "ê"],
}


def prose(lang, words, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def documents(spark, rows):
    return spark.createDataFrame([(*r, "s", "l", "h") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return [(i, prose(lang, 30, i), lang) for i, lang in enumerate(["xa", "xb", "xc"] * 40)]


@pytest.fixture(scope="module")
def model(spark, rows):
    return lm.learn(documents(spark, rows))


def test_counts_are_those_of_plain_loops(spark, rows):
    import zlib

    tables = {}
    for doc_id, text, lang in rows:
        if zlib.crc32(str(doc_id).encode()) % 3 == 1:
            continue
        for word in text.split():
            _, buckets = lm.grams(pa.array([word.lower()]))
            for kind, found in enumerate(buckets):
                for b in found.tolist():
                    tables[lang, kind, b] = tables.get((lang, kind, b), 0) + 1
    found = {(r["lang"], r["kind"], r["bucket"]): r["n"] for r in lm.gram_counts(documents(spark, rows)).collect()}
    assert found == tables


def test_word_likelihoods_are_chains_of_backed_off_counts(model):
    words = ["dota", "über", "çã", "q"]
    got = model.word_likelihoods(pa.array(words))
    for word, row in zip(words, got):
        plain = []
        for number in range(3):
            total = 0.0
            _, buckets = lm.grams(pa.array([word]))
            for single, one, pair, two, triple in zip(*buckets):
                chars, ones, pairs, twos, triples = (t[number] for t in model.tables)
                p = (chars[single] + 1) / (chars.sum() + 512)
                p = (pairs[pair] + 4 * p) / (ones[one] + 4)
                p = (triples[triple] + 4 * p) / (twos[two] + 4)
                total += math.log(p)
            plain.append(total)
        assert np.allclose(row, np.maximum(np.array(plain) - max(plain), -lm.MOST_PER_WORD), atol=1e-5)


def _plain_mixture(likely, penalty=lm.PENALTY):
    """The same choice for one text, written as loops, with every trial made."""
    n, languages = likely.shape
    chosen, shares = [int(likely.sum(axis=0).argmax())], [1.0]
    level = likely.sum(axis=0).max()
    while len(chosen) < languages:
        mixed = [sum(s * math.exp(row[c]) for c, s in zip(chosen, shares)) for row in likely]
        slopes = [-1.0 if m in chosen else sum(math.exp(r[m]) / x for r, x in zip(likely, mixed)) for m in range(languages)]
        trial = [*chosen, int(np.argmax(slopes))]
        k = len(trial)
        parts = np.array([s * (1 - 1 / k) for s in shares] + [1 / k])
        for _ in range(lm.ROUNDS):
            weights = np.exp(likely[:, trial]) * parts
            new = (weights / weights.sum(axis=1, keepdims=True)).mean(axis=0)
            far = np.abs(new - parts).max() > lm.CLOSE
            parts = new
            if not far:
                break
        reached = np.log((np.exp(likely[:, trial]) * parts).sum(axis=1)).sum()
        if reached - level <= penalty + math.log(n) / 2:
            break
        chosen, shares, level = trial, parts.tolist(), reached
    return dict(zip(chosen, shares))


def test_mixtures_are_those_of_plain_loops(model):
    texts = [prose("xa", 40, 1), prose("xb", 3, 2), prose("xa", 30, 3) + " " + prose("xc", 20, 4), "dota über", ""]
    texts += [" ".join(prose(x, 25, 5) for x in SYLLABLES), prose("xc", 200, 8) + " " + prose("xb", 9, 3)]
    words = lm.clean_words(pa.array(texts, pa.large_string()))
    likely = model.word_likelihoods(words.distinct)
    found = lm.infer(likely, words.ids, words.starts)
    for i in range(len(texts)):
        mine = likely[words.ids[words.starts[i] : words.starts[i + 1]]]
        got = {c: s for c, s in zip(found.chosen[i].tolist(), found.shares[i].tolist()) if c >= 0}
        expected = _plain_mixture(mine) if len(mine) else {}
        assert got.keys() == expected.keys()
        assert all(abs(got[c] - expected[c]) < 1e-6 for c in got)


def test_proportions_and_held_out_rows(spark, rows, model):
    mixed = prose("xa", 60, 901) + " " + prose("xb", 30, 902)
    fresh = [(900 + i, prose(lang, 12, 500 + i), lang) for i, lang in enumerate(["xa", "xb", "xc"] * 10)]
    found = {r["doc_id"]: r for r in lm.identify(documents(spark, [*fresh, (999, mixed, None)]), model).collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in fresh)
    assert found[999]["languages"] == ["xa", "xb"]
    assert abs(found[999]["shares"][0] - 2 / 3) < 0.1 and abs(sum(found[999]["shares"]) - 1) < 1e-6
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_labels_of_held_out_documents_teach_nothing(spark, rows):
    import zlib

    def held(i):
        return zlib.crc32(str(i).encode()) % 3 == 1

    changed = [(i, "zzz qqq", "xq") if held(i) else (i, t, lang) for i, t, lang in rows]
    first, second = (lm.learn(documents(spark, r)) for r in (rows, changed))
    assert first.names == second.names and all((a == b).all() for a, b in zip(first.tables, second.tables))


def test_nulls_texts_without_letters_and_repeats(spark, model):
    texts = [None, "", "123 !? — 45", "—", "日本", "É", "a" * 300_000, prose("xb", 30_000, 1)]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(None, "dota", None), (7, "über", "xb")]
    found = lm.identify(documents(spark, rows), model).collect()
    assert len(found) == len(rows)
    by_text = [next(r for r in found if r["doc_id"] == i) for i in range(8)]
    assert [r["lang_pred"] == "und" for r in by_text] == [True] * 4 + [False] * 4
    assert all(r["score"] == 0 and r["languages"] == [] for r in by_text[:4])
    assert [r["held_out"] for r in found if r["doc_id"] is None] == [False]


def test_nothing_learned_and_empty_tables(spark, model):
    nothing = lm.learn(documents(spark, [(1, "dota", None), (2, None, "xa")]))
    assert [r["lang_pred"] for r in lm.identify(documents(spark, [(1, "dota", None)]), nothing).collect()] == ["und"]
    assert lm.identify(documents(spark, []), model).collect() == []
