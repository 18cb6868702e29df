import random
import re
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from llm import decontaminate, jaccard_join, line_dedup, vector_search
from llm.components import connected_components
from presswork.sources.shared import new_path


def distance(pattern, text):
    """Lowest edit distance of a pattern to a part of a text, and its first end, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        after = [i]
        for j, b in enumerate(text, 1):
            after.append(min(row[j] + 1, after[-1] + 1, row[j - 1] + (a != b)))
        row = after
    return min(row), row.index(min(row))


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(4)
    for edges in ([], [(1, 2), (2, 2), (None, 3)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(50)]):
        found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
        proper = [(a, b) for a, b in edges if None not in (a, b) and a != b]
        assert sorted(map(tuple, found)) == sorted(groups(proper, {n for e in proper for n in e}).items())
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    proper = [e for e in edges if e[0] != e[1]]
    assert found == groups(proper, {n for e in proper for n in e})


def test_myers_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        pattern = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 80)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        assert decontaminate.Pattern(pattern).nearest(text) == distance(pattern, text)


def test_leaks_equal_brute_force(spark, frame, prose):
    rng = random.Random(5)
    items = [(i, prose(rng.randint(8, 40), i)) for i in range(12)] + [(50, None), (51, "tiny"), (None, prose(20, 77)), (3, prose(9, 3))]
    rows = []
    for i in range(60):
        text = prose(rng.randint(0, 80), 1000 + i)
        item = items[i % 12][1]
        edits = list(item)
        for _ in range(rng.randrange(int(len(item) * 0.16) + 1)):
            edits[rng.randrange(len(edits))] = rng.choice(["", "q", "zz"])
        rows.append((i, text + ".\n" + "".join(edits).upper() + "! " + text if i % 4 else text))
    rows += [(None, items[0][1]), (70, None), (71, ""), (72, items[1][1]), (72, items[1][1])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find_leaks(frame(rows), benchmark).collect()
    expected = set()
    for doc, text in rows:
        plain = decontaminate.normalise(text or "")
        for item, item_text in items:
            pattern = decontaminate.normalise(item_text or "")
            errors = decontaminate.budget(len(pattern))
            if len(pattern) >= decontaminate.MIN_CHARS and (near := distance(pattern, plain)[0]) <= errors:
                expected.add((doc, item, near, errors))
    assert {(r["doc_id"], r["item_id"], r["distance"], r["budget"]) for r in found} == expected
    assert any(r["distance"] > 0 for r in found) and sum(r["doc_id"] == 72 for r in found) >= 2
    texts = dict(rows)
    for r in (r for r in found if r["distance"] == 0 and r["doc_id"] is not None):
        span = decontaminate.normalise(texts[r["doc_id"]][r["start"] : r["end"]])
        assert span in [decontaminate.normalise(t or "") for _, t in items]
    assert decontaminate.find_leaks(frame([]), benchmark).count() == 0
    assert decontaminate.find_leaks(frame(rows), benchmark.limit(0)).count() == 0


def test_short_items_are_found_between_bounds(spark, frame):
    import corpus_pipeline

    items = [(1, "What is 6 x 7?"), (2, "日本の首都はどこですか"), (3, "¿Quién?"), (4, "tiny"), (5, "?!"), (6, "中国的首都是哪里?"), (7, "x" * 23)]
    rows = [(1, "Q: WHAT is\n6 x 7 -- 42"), (2, "what is 6 x 77"), (3, "では、日本の首都はどこですかと聞く"), (4, "日本の首都はどこ"), (5, "aquién")]
    rows += [(6, "tinyness, untiny; Tiny."), (7, "?!"), (8, "问题：中国的首都是哪里？答案"), (9, "what is 6 y 7"), (10, "x" * 24), (11, "x" * 23), (12, None)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find_leaks(frame(rows), benchmark).collect()
    texts, names = dict(rows), dict(items)
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (3, 2), (6, 4), (8, 6), (11, 7)}
    for r in found:
        item = decontaminate.normalise(names[r["item_id"]])
        assert decontaminate.normalise(texts[r["doc_id"]][r["start"] : r["end"]]) == item
        assert (r["distance"], r["budget"], r["length"]) == (0, 0, len(item))
    assert [r["start"] for r in found if r["doc_id"] == 6] == [18]
    stage = dict(corpus_pipeline.STAGES)["benchmark decontamination"]
    folder = f"{new_path(spark, 'short-items')}"
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    assert sorted(r["doc_id"] for r in stage(spark, frame(rows), folder).collect()) == [2, 4, 5, 7, 9, 10, 12]


def test_search_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.1, 16)]) for i in range(300)]
    vectors += [(i, vectors[7][1]) for i in range(300, 340)] + [(400, None), (401, [None] * 16), (402, [float("nan")] * 16)]
    vectors += [(403, [float("inf")] * 16), (None, vectors[1][1]), (404, []), (405, [1.0])]
    df = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id bigint, embedding array<float>, score string")
    monkeypatch.setattr(vector_search, "CANDIDATES", 64)
    monkeypatch.setattr(vector_search, "QUERIES", 5)
    found = set(map(tuple, vector_search.search(df, 20).collect()))
    stored = [(i, v) for i, v in map(tuple, df.select("vec_id", "embedding").collect()) if i is not None and v is not None]
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in stored if all(x is not None and np.isfinite(x) for x in v)}
    expected = set()
    for q in (i for i in whole if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        expected |= {(q, rank, i, -score) for rank, (score, i) in enumerate(scores[:20], 1)}
    assert found == expected
    assert vector_search.search(df.limit(0), 20).count() == 0


def shingle_sets(rows):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        pieces = [tuple(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [tuple(words)] * bool(words)
        sets[i] = frozenset(pieces)
    return sets


def jaccard_brute(rows):
    sets = shingle_sets(rows)
    linked = [
        (a, b)
        for a, b in combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    ]
    component = groups(linked, sets)
    return {(i, len(s), component[i]) for i, s in sets.items()}


def near_copies(prose, families=14, members=9):
    """Families of texts whose members are up to a few edits apart, around the similarity that links."""
    rng = random.Random(8)
    rows = []
    for family in range(families):
        words = prose(rng.choice([5, 12, 14, 40, 90, 200, 400]), family, 10**6).split()
        for _ in range(members):
            words = list(words) if rng.random() < 0.5 else words
            changed = list(words)
            for _ in range(rng.randrange(max(2, len(words) // 25))):
                changed[rng.randrange(len(changed))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows) + 10, "  ".join(changed)))
            words = changed if rng.random() < 0.4 else words
    return rows


def test_jaccard_equals_brute_force(spark, frame, prose, monkeypatch):
    rows = near_copies(prose)
    rows += [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"), (905, "É x"), (906, "é x"), (907, "a b a b a b a b")]
    rows += [(908, rows[0][1]), (1, rows[3][1].upper())]
    found = jaccard_join.jaccard_components(frame(rows))
    assert set(map(tuple, found.collect())) == jaccard_brute(rows)


def test_link_counts_equal_brute_force(spark, frame, prose, monkeypatch):
    """Every link of every row, also between blocks, weighted by copies."""
    rows = near_copies(prose)
    rows += [(900, None), (901, ""), (903, "One two"), (904, "one TWO"), (None, rows[0][1]), (5, rows[3][1]), (5, rows[3][1]), (6, prose(40, 3))]
    rows += [(1000 + i, rows[3][1].upper()) for i in range(4)]
    sets = [shingle_sets([row])[row[0]] for row in rows]
    expected = []
    for a, (i, _) in enumerate(rows):
        near = [b for b, (j, _) in enumerate(rows) if b != a and j is not None and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
        expected.append((-1 if i is None else i, -1 if i is None else len(near)))
    assert max(n for _, n in expected) >= 6
    for block in (jaccard_join.COUNT_BLOCK, 3):
        monkeypatch.setattr(jaccard_join, "COUNT_BLOCK", block)
        found = jaccard_join.jaccard_links(frame(rows))
        assert found.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
        rows_found = [(-1, -1) if r["doc_id"] is None else (r["doc_id"], r["n_links"]) for r in found.collect()]
        assert sorted(rows_found) == sorted(expected)
    assert jaccard_join.jaccard_links(frame([])).count() == 0


def test_jaccard_of_repeated_and_nameless_rows(spark, frame, prose):
    text = prose(60, 1)
    rows = [(5, text), (5, text), (7, text), (None, text), (2, prose(50, 2)), (5, prose(50, 2)), (8, prose(9, 3))]
    found = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in jaccard_join.jaccard_components(frame(rows)).collect())
    assert found == [(0, 0), (2, 2), (5, 2), (5, 2), (5, 2), (7, 2), (8, 8)]
    assert jaccard_join.jaccard_components(frame([])).count() == 0


def test_tiles_bound_sets_that_link():
    """Sets that link share a tile key, whatever differs, also where parts are empty."""
    import pyarrow as pa

    rng = random.Random(6)
    for _ in range(150):
        n = rng.choice([9, 10, 13, 19, 20, 40, 95, 300])
        base = [f"t{rng.randrange(10**6)}" for _ in range(n + 2)]
        other = list(base)
        for _ in range(rng.randrange(3)):
            other[rng.randrange(len(other))] = "other"
        other += [f"s{i}" for i in range(rng.randrange(max(1, n // 12)))]
        sets = jaccard_join.Sets(pa.array([" ".join(base), " ".join(other)], pa.large_string()))
        a, b = (set(sets.hashes[sets.bounds[i] : sets.bounds[i + 1]].tolist()) for i in (0, 1))
        owners, keys = sets.tile_keys()
        met = set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist())
        if a != b and 100 * len(a & b) >= 90 * len(a | b):
            assert met
        bits = sets.bitmaps()
        assert len(a & b) <= jaccard_join.overlap_bound(len(a), len(b), bits[0], bits[1])


def lines_brute(rows):
    first, keep = {}, {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for place, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\r\f\v").lower()
            if line:
                first.setdefault(line, (i, place))
    sets = {x: {x[k : k + 8] for k in range(max(1, len(x) - 7))} for x in first}
    linked = [(first[a], first[b]) for a, b in combinations(sets, 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    component = groups(linked, first.values())
    for place in first.values():
        if component[place] == place:
            keep.setdefault(place[0], []).append(place[1])
    return {i: sorted(places) for i, places in keep.items()}


def test_lines_equal_brute_force(spark, frame, prose):
    rng = random.Random(3)
    pool = [prose(rng.randint(1, 40), 50 + i, 10**6) for i in range(30)]
    rows = []
    for i in range(40):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 4))] + [prose(12, 500 + i, 10**6)]
        lines = [x.upper() + " " if rng.random() < 0.3 else x for x in lines]
        # One letter more leaves long lines nearly the same; short ones become others.
        lines = [x + "y" if rng.random() < 0.2 else x for x in lines]
        rows.append((i, "\n\n".join(lines) + "\n"))
    rows += [(90, None), (91, ""), (92, "\n \n"), (93, "a"), (94, "A")]
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame(rows)).collect()}
    expected = lines_brute(rows)
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for place, x in enumerate(lines) if not x.strip(" \t\r\f\v") or place in expected.get(i, [])]
        assert out[i]["n_kept"] == len(expected.get(i, []))
        assert out[i]["n_lines"] == sum(bool(x.strip()) for x in lines)
        assert out[i]["text"] == (None if text is None else "\n".join(kept))


def test_lines_of_odd_tables(spark, frame):
    rows = [(5, "same line\nown"), (5, "same line\nown"), (None, "same line"), (7, "x" * 200_000 + "\nsame line")]
    out = sorted((r["doc_id"] or 0, r["n_kept"]) for r in line_dedup.dedup_lines(frame(rows)).collect())
    assert out == [(0, 0), (5, 2), (5, 2), (7, 1)]
    assert line_dedup.dedup_lines(frame([])).count() == 0
    kept = line_dedup.drop_repeated_lines(frame(rows))
    assert kept.columns == frame(rows).columns and kept.where(F.col("doc_id").isNull()).count() == 0


def test_dropping_copies_keeps_every_line(spark, frame, prose):
    """Each component of lines of the input has a line in the output, however little is left of a document."""
    import corpus_pipeline

    passages = [prose(30, 300 + i, 10**6) for i in range(12)]
    rows = [(i, "\n".join(passages[4 * i : 4 * i + 4])) for i in range(3)]
    # Mostly repeated with a line of its own; a keeper that others have lost; one line many times; nothing left.
    rows += [(10, "\n".join([*passages, "only here"])), (11, "\n".join([*passages, "Shared end"])), (12, "shared end\n" + prose(9, 7, 10**6))]
    rows += [(13, "\n".join(["again and again"] * 9)), (14, "\n".join(passages)), (15, None), (16, "\n")]
    stage = dict(corpus_pipeline.STAGES)["line dedup"]
    out = {r["doc_id"]: r["text"] for r in stage(spark, frame(rows), "").collect()}
    expected = lines_brute(rows)
    assert out.keys() == {i for i, text in rows if not (text or "").strip() or i in expected}
    for i, places in expected.items():
        lines = dict(rows)[i].split("\n")
        assert [x for x in out[i].split("\n") if x] == [lines[p] for p in places]


def test_line_dedup_runs_no_python(spark, frame):
    lines = line_dedup.signed_lines(line_dedup.distinct_lines(frame([(1, "a line")])))
    plan = lines._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def edited(base, places):
    """A line with another letter at some places; places 8 or more apart change 8 shingles each."""
    return "".join("#" if i in places else x for i, x in enumerate(base))


def test_lines_of_a_family_that_are_not_similar_give_no_pairs(spark, frame, monkeypatch):
    """Lines that all differ by little more than a ninth are ruled out by their bitmaps, not compared two by two."""
    rng = random.Random(8)
    base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(500))
    # Four edits a line: two lines share 429 shingles of 557, a similarity of 0.77.
    lines = [edited(base, {8 + 16 * i + 120 * k for k in range(4)}) for i in range(7)]
    lines += [edited(base, {12 + 16 * i + 120 * k for k in range(4)}) for i in range(7)]
    lines += [edited(base, {16 + 16 * i + 112 * k for k in range(4)}) for i in range(6)]
    sizes, store = [], line_dedup.materialize

    def count(df, label):
        stored = store(df, label)
        sizes.append(stored.count() if label == "near-lines" else 0)
        return stored

    monkeypatch.setattr(line_dedup, "materialize", count)
    out = line_dedup.dedup_lines(frame(list(enumerate(lines)))).collect()
    expected = lines_brute(list(enumerate(lines)))
    assert {r["doc_id"]: r["n_kept"] for r in out} == {i: len(expected.get(i, [])) for i in range(len(lines))}
    assert max(sizes) <= len(lines)


def test_bitmaps_never_rule_out_similar_lines(spark):
    rng = random.Random(9)
    rows, pairs = [], []
    for i in range(150):
        length = rng.choice([5, 30, 90, 400, 3000])
        # Few letters: shingles repeat within a line.
        base = "".join(rng.choice("ab" if i % 2 else "abcdefgh ") for _ in range(length))
        other = edited(base, {rng.randrange(length) for _ in range(rng.randrange(1 + length // 80))})
        rows += [(2 * i, base), (2 * i + 1, other)]
        a, b = ({x[k : k + 8] for k in range(max(1, len(x) - 7))} for x in (base, other))
        pairs += [(2 * i, 2 * i + 1)] * (5 * len(a & b) >= 4 * len(a | b))
    lines = line_dedup._mapped(spark.createDataFrame(rows, "h bigint, line string"))
    every = spark.createDataFrame([(2 * i, 2 * i + 1) for i in range(150)], "a bigint, b bigint")
    found = line_dedup._verify(every, lines)
    assert sorted(map(tuple, found.collect())) == pairs and 30 < len(pairs) < 150
