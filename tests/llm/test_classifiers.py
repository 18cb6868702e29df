import random
import zlib

import numpy as np
import pyarrow as pa

from llm import quality, toxicity
from llm.common import learning_sample
from llm.features import char_ngrams, split_words, word_hashes


def texts_of(values):
    return pa.array(values, pa.large_string())


def words(n, rng, extra=()):
    found = [f"w{rng.randrange(300)}" for _ in range(n)]
    for word in extra:
        found[rng.randrange(n)] = word
    return " ".join(found)


def table(n, seed, bad):
    """Labelled texts, a third of class 1 by `bad`."""
    rng = random.Random(seed)
    return [(bad(rng) if i % 3 == 0 else words(rng.randint(20, 150), rng), int(i % 3 == 0)) for i in range(n)]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_features_do_not_depend_on_the_batch():
    values = ["the cat sat", "", "  cat\tthe\n", "日本 é cat"]
    together = split_words(texts_of(values))
    by_word = dict(zip(together.distinct.to_pylist(), word_hashes(together.distinct).tolist()))
    owner, grams = char_ngrams(together.distinct, range(2, 4), 1000)
    for i, value in enumerate(values):
        alone = split_words(texts_of([value]))
        assert [alone.distinct[j].as_py() for j in alone.ids] == value.split()
        ids = together.ids[together.starts[i] : together.starts[i + 1]]
        assert [together.distinct[j].as_py() for j in ids] == value.split()
        own, mine = char_ngrams(alone.distinct, range(2, 4), 1000)
        for j, (word, number) in enumerate(zip(alone.distinct.to_pylist(), word_hashes(alone.distinct).tolist())):
            assert by_word[word] == number
            place = together.distinct.to_pylist().index(word)
            assert sorted(mine[own == j]) == sorted(grams[owner == place])


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    values = [" ".join(rng.choice(["ab", "cde", "idiot", "foo", "ba"], size=n)) for n in (5, 70, 0, 30)]
    inputs = toxicity.prepare(texts_of(values))
    p = {k: v.astype(np.float64) for k, v in toxicity.new_parameters().items()}
    chosen = np.arange(len(inputs.text))
    label = (chosen % 2).astype(float)
    found, tables = toxicity.gradients(p, inputs, chosen, label)

    def loss():
        logits = toxicity.window_logits(p, inputs).astype(float)
        return np.mean(np.log1p(np.exp(-np.where(label == 1, logits, -logits))))

    def difference(array, at):
        kept, step = array[at], 1e-3
        array[at] = kept + step
        above = loss()
        array[at] = kept - step
        below = loss()
        array[at] = kept
        return (above - below) / (2 * step)

    for name, gradient in found.items():
        at = np.unravel_index(int(np.abs(gradient).argmax()), gradient.shape)
        assert abs(difference(p[name], at) - gradient[at]) < 1e-4
    for name, (rows, gradient) in zip(("words", "chars"), tables):
        total = gradient[rows == rows[0]].sum(axis=0)
        assert abs(difference(p[name], (rows[0], 0)) - total[0]) < 1e-4


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        inputs = toxicity.prepare(texts_of([" ".join(f"a{i}" for i in range(n))]))
        covered = {i for a, k in zip(inputs.first, inputs.length) for i in range(a, a + k)}
        assert covered == set(range(max(n, 1)))


def test_toxicity_finds_one_word_in_a_long_text():
    network = toxicity.train(table(300, 1, lambda r: words(r.randint(20, 150), r, ["vileword"] * 2)), rounds=5)
    rng = random.Random(9)
    values = [words(3000, rng, ["vileword"]), words(3000, rng), "", words(5, rng), words(9, rng, ["vileword"])]
    score = toxicity.score_texts(network, texts_of(values))
    assert ((score >= 0.7) == [True, False, False, False, True]).all()


def test_quality_holds_out(spark, frame):
    data = table(400, 2, lambda r: " ".join([f"w{r.randrange(300)}"] * r.randint(20, 150)))
    rows = [(i, text) for i, (text, _) in enumerate(data)] + [(None, None), (5000, ""), (5000, "")]
    labels = spark.createDataFrame([(i, 1 - bad) for i, (_, bad) in enumerate(data)], "doc_id bigint, quality int")
    documents = frame(rows)
    model = quality.fit(documents, labels)
    out = quality.score_documents(documents, model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["held_out"] == (r["doc_id"] is not None and held(r["doc_id"])) for r in out)
    right = [r["predicted"] == 1 - data[r["doc_id"]][1] for r in out if r["doc_id"] in range(400) and r["held_out"]]
    assert np.mean(right) > 0.95
    kept = quality.keep_good(documents, model)
    assert kept.columns == documents.columns
    assert kept.count() == sum(r["predicted"] for r in out)


def test_sample_is_bounded_and_blind_to_held_out_rows(spark, frame):
    documents = frame([(i, f"text {i}") for i in range(60)] + [(3, "again")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (4, None)], "doc_id bigint, quality int")
    sample = learning_sample(documents, labels, "quality", 5)
    assert [sum(label == v for _, label in sample) for v in (0, 1)] == [5, 5]
    assert not any(held(int(t.split()[1])) for t, _ in sample if t != "again")


def test_without_labels(spark, frame):
    documents, labels = frame([(1, "a b"), (2, None)]), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in quality.score_documents(documents, quality.fit(documents, labels)).collect()} == {0.5}
    assert {r["score"] for r in toxicity.score_documents(documents, toxicity.fit(documents, labels)).collect()} == {0.5}
    assert toxicity.score_documents(frame([]), toxicity.train([])).count() == 0


def test_fitting_gives_its_memory_back(spark):
    """After a fit the driver holds little more than before, not the features of its sample."""

    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096

    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(5000)]
    rows = [(i, " ".join(rng.choices(words, k=300))) for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1600)], "doc_id bigint, quality int")
    quality.fit(docs, labels, 10)
    before = resident()
    quality.fit(docs, labels)
    assert resident() - before < 24 << 20
