"""What the operators share: tables, the package on the executors, Arrow batches in bounded pieces."""

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text that a task works on at once, in bytes; a single longer text is worked on alone.
SLICE_BYTES = 2 << 20
# Largest side, as measured, that is sent to every executor.
BROADCAST_BYTES = 64 << 20
# Arrow batch that the JVM hands to a Python worker; both hold it whole. Spark's own 64 MB is 10,000 rows of most tables.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per session, and let rows come in small batches.

    A size of batches that the application was started with stands.
    """
    context = spark.sparkContext
    batch = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not context.getConf().contains(batch):
        spark.conf.set(batch, str(BATCH_BYTES))
    if getattr(context, "_llm_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="llm-"), "llm_operators.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(root.glob("*.py")):
            archive.write(path, f"llm/{path.name}")
    context.addPyFile(target)
    context._llm_shipped = True


def held_out(doc_id: Column) -> Column:
    """Whether a document's label must not be learned: crc32 of its id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learning_sample(
    documents: DataFrame, labels: DataFrame, label: str, per_class: int
) -> list[tuple[str, int]]:
    """Whole texts with their label, at most `per_class` of each class, for a model that fits in memory.

    Labels of held-out documents are left out before anything is chosen. The choice goes by a hash
    of the id; its ids, a bounded list, are broadcast to pick the texts.
    """
    usable = labels.where(~held_out(F.col("doc_id")) & F.col(label).isin(0, 1)).groupBy("doc_id")
    usable = usable.agg(F.max(label).cast("int").alias("_label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for value in (0, 1):
        part = usable.where(F.col("_label") == value).orderBy(*order).limit(per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Of texts that share an id the first in order: the choice is the same in every run.
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_label").agg(F.min("text").alias("text")).collect()
    return sorted(((r["text"], r["_label"]) for r in rows), key=lambda r: (hash_text(r[0]), r))


def hash_text(text: str) -> int:
    """A fixed order for training that follows from the text alone."""
    import zlib

    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def slices(
    batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_BYTES, kind: pa.DataType = pa.large_string()
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Pieces of the batches with about `size` bytes of text each, and the texts (null: empty).

    At the end Arrow gives back what it keeps for reuse: an idle worker counts towards its executor's memory.
    """
    for batch in batches:
        texts = pc.fill_null(batch.column(text).cast(kind), pa.scalar("", kind))
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(start, stop - start), texts.slice(start, stop - start)
            start = stop
        del texts
    pa.default_memory_pool().release_unused()


def give_back() -> None:
    """Return memory that was freed in small pieces to the system, where the C library can: glibc keeps it for reuse."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large_string or large_binary array and the offsets of its rows in them."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values over all bits."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def fits_broadcast(df: DataFrame, row_bytes: Column, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a stored frame, measured in one small job, may be sent to every executor."""
    size = df.agg(F.coalesce(F.sum(row_bytes.cast("bigint")), F.lit(0))).first()[0]
    return size <= limit


def without(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is not among `ids`, a stored frame of one column; null ids stay."""
    side = F.broadcast(ids) if fits_broadcast(ids, F.lit(32)) else ids
    return documents.join(side, "doc_id", "left_anti").select(documents.columns)
