"""Source divergence against counting by hand, its run-length form against plain columns, and its edges."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm import source_divergence as sd

SCHEMA = "doc_id bigint, text string, lang string, source string, value string, rank string, term string"


def brute(rows, least=3, top=200):
    said, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        small = "".join(c.lower() if c.isascii() else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", small)
        lang, source = lang or "", source or ""
        langs[lang].add(source)
        said[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = sum((said[lang, s] for s in sources), Counter())

        def share(counts, kept=kept):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept}

        q_lang = share(whole)
        for source in sources:
            p = share(said[lang, source])
            parts = {"pair": [], "term": []}
            for other in sources - {source}:
                q = share(said[lang, other])
                parts["pair"].append((other, sum((p[t] - q[t]) ** 2 // q[t] for t in kept)))
            for t in kept:
                if said[lang, source][t] and p[t] > q_lang[t]:
                    parts["term"].append((t, (p[t] - q_lang[t]) ** 2 // q_lang[t]))
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(items[: top if part == "term" else None], 1):
                    out.append((lang, source, part, item, value, rank))
    return sorted(out)


def documents(spark, rows):
    return spark.createDataFrame([(i, *r, "v", "r", "t") for i, r in enumerate(rows)], SCHEMA)


def answers(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["Éa", "ab", "ABC", "x1y", "z-q", "größe", "ÄB", "日本", "o", "oo", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = []
    for i in range(160):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 60])))
        rows.append((text, rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "a", "a", "b", "c", "É", None])))
    return [*rows, *rows[:9], (None, "en", "only"), ("word once", "fr", "s"), ("word", "fr", "t"), (None, None, None)]


def test_matches_counting_by_hand(spark, rows):
    assert answers(sd.audit_sources(documents(spark, rows))) == brute(rows)


def test_small_tiles_and_blocks_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(sd, "TILE_BITS", 2)
    monkeypatch.setattr(sd, "BLOCK_SOURCES", 2)
    assert answers(sd.audit_sources(documents(spark, rows), top=3)) == brute(rows, top=3)


def test_runs_give_what_whole_columns_give():
    rng = np.random.default_rng(5)
    for size in (0, 1, 2, 50, 400):
        a, b = (rng.integers(1, 4, size).astype(np.int64) * 10**8 for _ in range(2))
        plain = (int(((a - b) ** 2 // b).sum()), int(((a - b) ** 2 // a).sum()))
        assert sd.pair_values(sd.run_lengths(a), sd.run_lengths(b), size) == plain


def test_equal_counts_stand_together(spark):
    rows = [(" ".join(f"k{chr(97 + i)}" for i in range(20)), "en", s) for s in "aab"]
    placed = sd.vocabulary(sd.term_counts(documents(spark, [*rows, ("ka ka", "en", "b")]))).collect()
    at = {r["term"]: r["pos"] for r in placed}
    assert sorted(at.values())[0] == at["ka"] or sorted(at.values())[-1] == at["ka"]


def test_long_texts_and_empty_tables(spark):
    rows = [("ab " * 400_000, "en", "a"), ("ab cd", "en", "b"), ("ab", "en", "b")]
    assert answers(sd.audit_sources(documents(spark, rows))) == brute(rows)
    assert answers(sd.audit_sources(documents(spark, []))) == []


def test_large_counts_stay_exact(spark):
    n = spark.createDataFrame([(5 * 10**12, 10**13)], "n bigint, total bigint")
    share = n.select(sd._share(n["n"], n["total"]).alias("p")).first()["p"]
    assert share == 1 + 10**9 * (5 * 10**12 + 1) // 10**13
