import numpy as np
import pytest

from llm import training_order
from presswork.sources.shared import materialize, new_path


def test_permutation():
    for n in (1, 2, 3, 10, 1000, 4097):
        slots = training_order.permute(np.arange(n), n, 5)
        assert sorted(slots) == list(range(n))
        assert (training_order.permute(np.arange(n), n, 5) == slots).all()
    assert (training_order.permute(np.arange(1000), 1000, 6) != training_order.permute(np.arange(1000), 1000, 5)).any()


def test_round_trip_and_resume(spark, frame, prose):
    rows = [(i, prose(i * 7, i) + "é\n\x00") for i in range(50)] + [(60, None), (61, ""), (62, "x" * 64), (None, "nameless"), (62, "y")]
    path = new_path(spark, "order-test")
    layout = training_order.write_training_order(materialize(frame(rows), "stored"), path, 9, tokens=64, shard_slots=32)
    assert training_order.open_layout(spark, path) == layout
    read = training_order.read_order(spark, layout).collect()
    assert sorted(r["slot"] for r in read) == list(range(layout.sequences))
    texts = {}
    for r in sorted(read, key=lambda r: (r["doc_id"], r["piece"], bytes(r["ids"]))):
        assert len(r["ids"]) == r["n_tokens"] <= 64
        texts[r["doc_id"]] = texts.get(r["doc_id"], b"") + bytes(r["ids"])
    expected = {i: t.encode() for i, t in rows if t and i not in (None, 62)}
    assert {k: v for k, v in texts.items() if k not in (-1, 62)} == expected
    assert texts[-1] == b"nameless" and sorted(texts[62]) == sorted(b"x" * 64 + b"y")
    later = training_order.read_order(spark, layout, 40, 90).collect()
    by_slot = {r["slot"]: r for r in read}
    assert sorted(r["slot"] for r in later) == list(range(40, 90)) and all(by_slot[r["slot"]] == r for r in later)


def test_records_stand_at_their_places(spark, frame, prose):
    path = new_path(spark, "order-test")
    layout = training_order.write_training_order(frame([(1, prose(400, 1))]), path, 3, tokens=16, shard_slots=10)
    for row in spark.read.format("binaryFile").load(f"{path}/shards").collect():
        content, shard = row["content"], int(row["path"].split("shard=")[1].split("/")[0])
        assert len(content) % layout.stride == 0
        for at in range(0, len(content), layout.stride):
            slot = int.from_bytes(content[at : at + 8], "little")
            assert slot == shard * 10 + at // layout.stride


def test_sequences_hold_token_ids(spark, frame, prose):
    """Ids of the whole text, as the library gives them, come back from the shards of the registered query's encoder."""
    pytest.importorskip("public_tokenizers")
    import sentencepiece
    from llm import sentencepieces
    from llm.queries import PIECES, tokenizer_path

    model = tokenizer_path(PIECES)
    encoder = sentencepieces.id_encoder(model)
    rows = [(i, prose(i * 9, i) + "  é \n日本 \x00") for i in range(30)] + [(60, None), (61, ""), (62, " "), (63, "\n\n a"), (None, "nameless")]
    path = new_path(spark, "order-test")
    layout = training_order.write_training_order(frame(rows), path, 9, tokens=50, shard_slots=16, encoder=encoder)
    assert training_order.open_layout(spark, path) == layout and layout.id_bytes == 2
    found = {}
    for r in sorted(training_order.read_order(spark, layout).collect(), key=lambda r: (r["doc_id"], r["piece"])):
        ids = np.frombuffer(bytes(r["ids"]), "<u2").tolist()
        assert len(ids) == r["n_tokens"] <= 50
        found[r["doc_id"]] = found.get(r["doc_id"], []) + ids
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    assert found == {-1 if i is None else i: library.encode(t) for i, t in rows if t}
    for row in spark.read.format("binaryFile").load(f"{path}/shards").collect():
        assert len(row["content"]) % layout.stride == 0 and layout.stride == 24 + 100 + 1


def test_order_encoder_keeps_no_cuts():
    """A worker that only needs ids builds neither the second tokenizer nor a store of cuts."""
    pytest.importorskip("public_tokenizers")
    import pyarrow as pa
    from llm import sentencepieces
    from llm.queries import PIECES, tokenizer_path

    model = tokenizer_path(PIECES)
    sentencepieces.codec.cache_clear()
    texts = pa.array(["some words of text", "", " ", "é▁x  \n日本 \x00 \U0001f600"], pa.large_string())
    ids, bounds = sentencepieces.id_encoder(model).encode(texts)
    used = sentencepieces.codec(model)
    assert not used._known.place and not {"cuts", "texts"} & set(used.__dict__)
    expected = sentencepieces.Codec(model).ids(texts)
    assert ids.tolist() == expected[0].tolist() and bounds.tolist() == expected[1].tolist()


def test_library_is_given_each_cut_once(monkeypatch):
    """Ids from distinct cuts are those of the whole texts, and the library sees far less text."""
    pytest.importorskip("public_tokenizers")
    import random

    import pyarrow as pa
    from llm import sentencepieces
    from llm.queries import PIECES, tokenizer_path

    used = sentencepieces.Codec(tokenizer_path(PIECES))
    rng = random.Random(2)
    parts = [" ", "  ", "▁", "\n", "a", "the", "é", "日本", "\x00", "\U0001f600", "<s>", "<unk>", "<0x41>", "　", "x" * 30]
    for _ in range(200):
        rows = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(9))]
        found, expected = (f(pa.array(rows, pa.large_string())) for f in (used.library_cut_ids, used.library_ids))
        assert found[0].tolist() == expected[0].tolist() and found[1].tolist() == expected[1].tolist()

    seen, library = [], used.library

    class Counting:
        def encode(self, texts, num_threads):
            seen.append(sum(map(len, texts)))
            return library.encode(texts, num_threads=num_threads)

    monkeypatch.setattr(sentencepieces, "codec", lambda path: used)
    used.__dict__["library"] = Counting()
    texts = pa.array([" ".join(rng.choice(["some", "words", "of", "text "]) for _ in range(500))] * 4, pa.large_string())
    ids, _ = sentencepieces.id_encoder(tokenizer_path(PIECES)).encode(texts)
    assert sum(seen) < 100 and ids.tolist() == [i for x in texts.to_pylist() for i in library.encode(x)]


def test_shards_are_written_in_passes_that_leave_no_shuffle(spark, frame, prose, monkeypatch):
    """A pass shuffles its own shards only, and its files go with it; the records do not depend on the passes."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = blocks.getAllBlocks()
        return {b for b in (found.apply(i).name() for i in range(found.size())) if b.startswith("shuffle_") and b.endswith(".data")}

    documents = materialize(frame([(i, prose(30 + i, i)) for i in range(60)]), "stored")
    contents = []
    for passes in (training_order.PASSES, 1, 5):
        monkeypatch.setattr(training_order, "PASSES", passes)
        path, before = new_path(spark, "order-test"), shuffled()
        layout = training_order.write_training_order(documents, path, 7, tokens=64, shard_slots=20)
        assert layout.shards > 5 and not shuffled() - before
        files = spark.read.format("binaryFile").load(f"{path}/shards").collect()
        contents.append(sorted((r["shard"], bytes(r["content"])) for r in files))
    assert contents[0] == contents[1] == contents[2] and len(contents[0]) == layout.shards
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_rows_come_to_workers_in_small_batches(spark):
    """Executor and worker both hold a batch whole, so its bytes are bounded, not only its rows."""
    import pyarrow as pa
    from llm.common import BATCH_BYTES, ship

    ship(spark)
    rows = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat('x', 4096) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    found = [r["n"] for r in rows.mapInArrow(sizes, "n bigint").collect()]
    assert sum(found) == 4000 and max(found) * 4096 < 2 * BATCH_BYTES


def test_registered_query_counts_token_ids(spark):
    pytest.importorskip("public_tokenizers")
    from llm.queries import QUERIES

    def tokens(name):
        rows = QUERIES[name](spark, "/root/testdata/sf0.001").groupBy("doc_id").sum("n_tokens").collect()
        return {r[0]: r[1] for r in rows if r[1]}

    assert tokens("op1_training_order") == tokens("op8_sentencepiece")


def test_empty_table(spark, frame):
    layout = training_order.write_training_order(frame([]), new_path(spark, "order-test"), 1)
    assert layout.sequences == 0 and training_order.read_order(spark, layout).count() == 0


def test_pipeline_stages(spark, frame, prose):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline
    from llm.decontaminate import find_leaks

    text = prose(300, 1, 10**6)
    rows = [(1, text), (2, text), (3, text + " end"), (4, prose(200, 4, 10**6)), (5, "intro\n" + prose(40, 9, 10**6)), (None, prose(90, 6, 10**6)), (8, None)]
    documents = frame(rows)
    names = [name for name, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    lines = stages[names[1]](spark, documents, "")
    assert lines.columns == documents.columns
    assert sorted(r["doc_id"] or 0 for r in lines.collect()) == [0, 1, 4, 5, 8]
    near = stages[names[2]](spark, documents, "")
    assert near.columns == documents.columns
    assert sorted(r["doc_id"] or 0 for r in near.collect()) == [0, 1, 4, 5, 8]
    benchmark = spark.createDataFrame([(1, prose(40, 9, 10**6))], "item_id bigint, text string")
    assert [r["doc_id"] for r in find_leaks(documents, benchmark).collect()] == [5]
    encoded = stages[names[4]](spark, documents, "")
    assert encoded.count() == len(rows) and all(r["parity"] for r in encoded.collect())


def test_pipeline_equals_its_stages_by_hand(spark):
    """On the smallest table: what stays is what brute force over each stage's input would keep."""
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline
    from llm import decontaminate
    from llm.common import read_table

    sf_dir = "/root/testdata/sf0.001"
    docs = read_table(spark, sf_dir, "documents")
    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, sf_dir, "labels").collect()}
    items = [decontaminate.normalise(r["text"]) for r in read_table(spark, sf_dir, "benchmark").collect()]
    final = {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert not any(any(i in decontaminate.normalise(texts[d]) for i in items) for d in final)
    assert len({texts[d] for d in final}) == len(final)
    good = [d for d in texts if labels.get(d) == 1]
    bad = [d for d in texts if labels.get(d) == 0]
    assert sum(d in final for d in bad) <= 0.1 * len(bad)
    leaked = {d for d in good if any(i in decontaminate.normalise(texts[d]) for i in items)}
    clean = [d for d in good if d not in leaked]
    assert sum(d in final for d in clean) >= 0.75 * len(clean)
