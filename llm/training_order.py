"""Training-order materialisation: every sequence at a slot given by a keyed permutation.

Documents become sequences of token ids of fixed length, each id of as many bytes as the vocabulary calls
for. An encoder gives the ids; they are stored once, so that counting and writing read the same ones.
Without an encoder ids are the bytes of the text. A Feistel network over the
smallest even number of bits that holds all sequence numbers, walked until it lands below their count,
gives each sequence one slot in 0 .. n-1. Shards take equal ranges of slots; a record is a
header, the ids, padding and an end mark, always of the same size, so slot s stands at byte
(s mod shard slots) * stride of its shard, and a reader can go on at any slot.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import mix, ship, slices, utf8_bytes
from presswork.sources.shared import delete_path, new_path

SEQUENCE_TOKENS = 512
# 69 MB a shard; many terabytes call for more.
SHARD_SLOTS = 1 << 16
# Jobs that write the shards, a range of them each, one after another.
PASSES = 2
# Text that is encoded at once.
ENCODE_BYTES = 1 << 20
# Record: slot, document, sequence within it, tokens; then the ids (little-endian), zeros and a line feed.
HEADER = np.dtype([("slot", "<i8"), ("doc_id", "<i8"), ("piece", "<i4"), ("tokens", "<i4")])
END = 10
ROUNDS = 6


@dataclass(frozen=True)
class Encoder:
    """Gives the ids of texts, one after another, with their bounds; an id takes `id_bytes` bytes (1, 2 or 4)."""

    encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
    id_bytes: int


@dataclass(frozen=True)
class Layout:
    """What a reader needs to know about the files."""

    path: str
    sequences: int
    sequence_tokens: int
    shard_slots: int
    id_bytes: int = 1

    @property
    def stride(self) -> int:
        return HEADER.itemsize + self.sequence_tokens * self.id_bytes + 1

    @property
    def shards(self) -> int:
        return max(1, -(-self.sequences // self.shard_slots))


def permute(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each sequence number: a permutation of 0 .. n-1 fixed by the key."""
    half = np.uint64(max(1, ((max(n - 1, 1)).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + mix(np.array([key % 2**64], np.uint64)))

    def encrypt(values: np.ndarray) -> np.ndarray:
        left, right = values >> half, values & mask
        for round_key in keys:
            left, right = right, left ^ (mix(right ^ round_key) & mask)
        return left << half | right

    slots = encrypt(numbers.astype(np.uint64))
    outside = np.flatnonzero(slots >= np.uint64(n))
    while len(outside):
        slots[outside] = encrypt(slots[outside])
        outside = outside[slots[outside] >= np.uint64(n)]
    return slots.astype(np.int64)


def pieces_of(size: Column, width: int) -> Column:
    """Sequences, of `width` bytes, of a document whose ids take so many bytes; an empty one has none."""
    return F.ceil(size / width).cast("bigint")


def encode_ids(documents: DataFrame, encoder: Encoder) -> DataFrame:
    """doc_id and ids, as bytes, of every document."""
    kind = np.dtype(f"<u{encoder.id_bytes}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text", ENCODE_BYTES):
            ids, bounds = encoder.encode(texts)
            if len(ids) and (ids.min() < 0 or ids.max() > np.iinfo(kind).max):
                raise ValueError(f"an id does not fit in {encoder.id_bytes} bytes")
            ends = pa.py_buffer((bounds * encoder.id_bytes).astype(np.int32))
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, ends, pa.py_buffer(ids.astype(kind))])
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), packed], ["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids binary")


def _records(
    packed: pa.Array, ids: np.ndarray, number: int, layout: Layout, key: int, wanted: range
) -> tuple[int, np.ndarray, np.ndarray]:
    """How many sequences some documents' token ids have, numbered from `number`; slots and records of those in wanted slots."""
    width = layout.sequence_tokens * layout.id_bytes
    content, offsets = utf8_bytes(packed)
    sizes = np.diff(offsets)
    pieces = -(-sizes // width)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    n = len(owner)
    slots = permute(number + np.arange(n), layout.sequences, key)
    chosen = np.flatnonzero((slots >= wanted.start) & (slots < wanted.stop))
    slots, owner, piece = slots[chosen], owner[chosen], piece[chosen]
    filled = np.minimum(width, sizes[owner] - piece * width)
    records = np.zeros((len(owner), layout.stride), np.uint8)
    header = np.zeros(len(owner), HEADER)
    header["slot"], header["doc_id"], header["piece"], header["tokens"] = slots, ids[owner], piece, filled // layout.id_bytes
    records[:, : HEADER.itemsize] = header.view(np.uint8).reshape(-1, HEADER.itemsize)
    start = offsets[owner] + piece * width
    body = records[:, HEADER.itemsize : -1]
    for row, at, size in zip(body, start.tolist(), filled.tolist()):
        row[:size] = content[at : at + size]
    records[:, -1] = END
    return n, slots, records


def _packed(shards: np.ndarray, records: np.ndarray) -> pa.RecordBatch:
    """Records gathered by shard and compressed together, so that less is shuffled."""
    order = np.argsort(shards, kind="stable")
    found, at = np.unique(shards[order], return_index=True)
    codec = pa.Codec("zstd")
    groups = np.split(order, at[1:]) if len(found) else []
    blobs = [codec.compress(records[group].tobytes(), asbytes=True) for group in groups]
    sizes = [len(group) for group in groups]
    columns = [pa.array(found.astype(np.int32)), pa.array(sizes, pa.int32()), pa.array(blobs, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["shard", "records", "blob"])


def write_training_order(
    documents: DataFrame,
    path: str,
    key: int,
    tokens: int = SEQUENCE_TOKENS,
    shard_slots: int = SHARD_SLOTS,
    encoder: Encoder | None = None,
) -> Layout:
    """Write the sequences of all documents (doc_id bigint, text) in training order to shards under `path`.

    With an encoder its ids are stored first, in the shared folder until the shards are written. Without one
    ids are bytes, and the documents must be a stored table, without a shuffle since, so that it reads alike twice.
    A first job counts the sequences of every input split; others, over the same splits, number and
    permute them all, and each shuffles the sequences of a range of shards once, by shard. What one has shuffled is
    removed when it ends, so ids, shards and a part of the shuffle lie on disk together. Splits are told apart by number
    and checked: should a job see others, it fails, and without a layout nothing can be opened. Null and empty texts
    give no sequence, null ids are written as -1. Files are written by Spark's own writer, whose commit makes a task
    that was run twice count once.
    """
    spark = documents.sparkSession
    ship(spark)
    pinned, cleaned = "spark.sql.files.minPartitionNum", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = {name: spark.conf.get(name, None) for name in (pinned, cleaned)}
    # Without this the size of splits follows the number of live cores, which may change between jobs.
    spark.conf.set(pinned, before[pinned] or str(spark.sparkContext.defaultParallelism))
    spark.conf.set(cleaned, "true")
    named = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    stored = new_path(spark, "token-ids") if encoder else None
    try:
        if encoder:
            encode_ids(named, encoder).write.option("compression", "zstd").parquet(stored)
            packed = spark.read.schema("doc_id bigint, ids binary").parquet(stored)
        else:
            packed = named.select("doc_id", F.col("text").cast("binary").alias("ids"))
        return _write(packed, path, key, tokens, shard_slots, encoder.id_bytes if encoder else 1)
    finally:
        if stored:
            delete_path(spark, stored)
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _write(documents: DataFrame, path: str, key: int, tokens: int, shard_slots: int, id_bytes: int) -> Layout:
    spark = documents.sparkSession
    size = F.coalesce(F.octet_length("ids"), F.lit(0))
    counted = documents.groupBy(F.spark_partition_id().alias("split")).agg(
        F.sum(pieces_of(size, tokens * id_bytes)).alias("n")
    )
    # One number per input split.
    counts = {r["split"]: r["n"] for r in counted.collect()}
    splits = np.zeros(max(counts, default=-1) + 2, np.int64)
    for split, n in counts.items():
        splits[split + 1] = n
    first = spark.sparkContext.broadcast(np.cumsum(splits))
    layout = Layout(path, int(first.value[-1]), tokens, shard_slots, id_bytes)

    def run(wanted: range, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        split = TaskContext.get().partitionId()
        bounds = first.value
        number = start = int(bounds[min(split, len(bounds) - 1)])
        for rows, packed in slices(batches, "ids", kind=pa.large_binary()):
            ids = rows.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
            n, slots, records = _records(packed, ids, number, layout, key, wanted)
            number += n
            # The end mark is the writer's line feed.
            yield _packed(slots // shard_slots, records[:, :-1])
        expected = int(bounds[split + 1]) - start if split + 1 < len(bounds) else 0
        if number - start != expected:
            raise RuntimeError(f"split {split} gave {number - start} sequences after {expected} were counted")

    width = layout.stride - 1

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            # Blobs stay where they are: all of a batch as objects of Python would be a second copy of it.
            for shard, n, blob in zip(rows.column("shard").to_pylist(), rows.column("records").to_pylist(), rows.column("blob")):
                content = pa.Codec("zstd").decompress(blob.as_buffer(), n * width)
                ends = np.arange(n + 1, dtype=np.int32) * width
                binary = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), content])
                slots = np.frombuffer(content, np.uint8).reshape(n, width)[:, :8].copy().view("<i8").ravel()
                shards = pa.array(np.full(n, shard, np.int32))
                yield pa.RecordBatch.from_arrays([shards, pa.array(slots), binary], ["shard", "slot", "record"])

    passes = min(PASSES, layout.shards)
    edges = [layout.shards * i // passes for i in range(passes + 1)]
    for low, high in zip(edges, edges[1:]):
        wanted = range(low * shard_slots, high * shard_slots)
        packed = documents.mapInArrow(partial(run, wanted), "shard int, records int, blob binary")
        dealt = packed.repartitionById(high - low, F.col("shard") - low)
        placed = dealt.mapInArrow(unpack, "shard int, slot bigint, record binary")
        (
            placed.sortWithinPartitions("shard", "slot")
            .select("shard", F.col("record").cast("string").alias("value"))
            .write.mode("append" if low else "overwrite")
            .option("lineSep", chr(END))
            .partitionBy("shard")
            .text(f"{path}/shards")
        )
    manifest = [(layout.sequences, tokens, shard_slots, id_bytes, layout.stride)]
    names = "sequences bigint, sequence_tokens int, shard_slots int, id_bytes int, stride int"
    spark.createDataFrame(manifest, names).coalesce(1).write.mode("overwrite").json(f"{path}/layout")
    return layout


def open_layout(spark: SparkSession, path: str) -> Layout:
    names = "sequences bigint, sequence_tokens int, shard_slots int, id_bytes int, stride int"
    row = spark.read.schema(names).json(f"{path}/layout").first()
    return Layout(path, row["sequences"], row["sequence_tokens"], row["shard_slots"], row["id_bytes"] or 1)


def read_order(spark: SparkSession, layout: Layout, start: int = 0, stop: int | None = None) -> DataFrame:
    """Sequences of the slots start .. stop-1: slot, doc_id, piece, n_tokens and ids (id_bytes bytes each).

    Only the shards that hold these slots are read, and in them records are cut at their places.
    """
    stop = layout.sequences if stop is None else min(stop, layout.sequences)
    if not layout.sequences or start >= stop:
        return spark.createDataFrame([], "slot bigint, doc_id bigint, piece int, n_tokens int, ids binary")
    files = spark.read.format("binaryFile").load(f"{layout.path}/shards").select("content", "shard")
    low, high = start // layout.shard_slots, (stop - 1) // layout.shard_slots
    base = F.col("shard").cast("bigint") * layout.shard_slots
    first = F.greatest(F.lit(start) - base, F.lit(0))
    last = F.least(F.lit(stop) - base, F.lit(layout.shard_slots)) - 1
    chosen = files.where(F.col("shard").between(low, high))
    stride = layout.stride
    places = chosen.select("content", F.explode(F.sequence(first, last)).alias("_at"))
    record = F.substring(F.col("content"), (F.col("_at") * stride + 1).cast("int"), F.lit(stride)).alias("r")
    cut = places.select(record)

    def number(at: int, size: int) -> Column:
        """A little-endian integer of the header."""
        big = F.reverse(F.hex(F.substring("r", at + 1, size)))
        turned = F.regexp_replace(big, "(.)(.)", "$2$1")
        return F.conv(turned, 16, -10).cast("bigint")

    tokens = number(20, 4).cast("int")
    return cut.select(
        number(0, 8).alias("slot"),
        number(8, 8).alias("doc_id"),
        number(16, 4).cast("int").alias("piece"),
        tokens.alias("n_tokens"),
        F.substring(F.col("r"), F.lit(HEADER.itemsize + 1), tokens * layout.id_bytes).alias("ids"),
    )
