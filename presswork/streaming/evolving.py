"""A Parquet folder that streams write by batch, stream and epoch: its schema grows, its epochs are merged.

Folders below the path with an underscore in front are no data to Spark's readers: `_schema` has the schema's
versions, `_counts` the rows of every epoch.
"""

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.sources.shared import delete_path, path_exists, paths_like
from presswork.sources.tables import FILE_BYTES, replace_partitions

PARTITION = ["batch", "stream", "epoch_id"]
# A stream's epochs in one batch are merged once there are so many.
MERGE_EPOCHS = 16


def _last(text: str) -> str:
    return text.rsplit("=", 1)[1]


def stored_schema(spark: SparkSession, path: str, first: T.StructType) -> T.StructType:
    """The schema as of the last write that added columns; `first` before any did."""
    versions = [_last(p) for p in paths_like(spark, f"{path}/_schema/v=*") if path_exists(spark, f"{p}/_SUCCESS")]
    if not versions:
        return first
    lines = spark.read.text(f"{path}/_schema/v={max(versions, key=int)}").collect()
    return T.StructType.fromJson(json.loads("".join(r["value"] for r in lines)))


def merge_schema(spark: SparkSession, path: str, first: T.StructType, new: T.StructType) -> T.StructType:
    """Add the columns of a write that the stored schema lacks. Older rows have nulls there.

    A column that comes with another type than it has is an error: nothing is written then.
    """
    old = stored_schema(spark, path, first)
    types = {f.name: f.dataType for f in old}
    for field in new:
        if types.get(field.name, field.dataType) != field.dataType:
            raise ValueError(f"column {field.name} is {types[field.name].simpleString()}, not {field.dataType.simpleString()}")
    added = [T.StructField(f.name, f.dataType) for f in new if f.name not in types]
    if not added:
        return old
    merged = T.StructType([*old.fields, *added])
    number = max([0, *(int(_last(p)) for p in paths_like(spark, f"{path}/_schema/v=*"))]) + 1
    spark.createDataFrame([(merged.json(),)], "value string").coalesce(1).write.text(f"{path}/_schema/v={number}")
    return merged


@dataclass
class Epochs:
    """The folders of one batch and stream: epochs not merged yet, and the merged ones by the last epoch that they hold."""

    folder: str
    single: list[int]
    merged: list[int]

    @property
    def covered(self) -> list[int]:
        """Numbers of folders whose rows a merged folder has too: left when a merge was cut short."""
        newest = max(self.merged, default=-1)
        return [e for e in self.single if e <= newest] + [-m - 1 for m in self.merged if m < newest]


def epochs_of(spark: SparkSession, folder: str) -> Epochs:
    numbers = [int(_last(p)) for p in paths_like(spark, f"{folder}/epoch_id=*")]
    return Epochs(folder, sorted(n for n in numbers if n >= 0), sorted(-n - 1 for n in numbers if n < 0))


def left_over(spark: SparkSession, path: str) -> dict[tuple[str, str], list[int]]:
    """By batch and stream, the folders that readers must pass over; none but after a merge was cut short."""
    found = {}
    for merged in paths_like(spark, f"{path}/batch=*/stream=*/epoch_id=-*"):
        folder = merged.rsplit("/", 1)[0]
        batch, stream = (_last(part) for part in folder.rsplit("/", 2)[1:])
        if covered := epochs_of(spark, folder).covered:
            found[batch, stream] = covered
    return found


def read_evolving(spark: SparkSession, path: str, first: T.StructType) -> DataFrame:
    """All rows in the stored schema, each once."""
    rows = spark.read.schema(stored_schema(spark, path, first)).parquet(path)
    for (batch, stream), epochs in left_over(spark, path).items():
        same = F.col("batch").cast("string").eqNullSafe(F.lit(batch)) & (F.col("stream") == stream)
        rows = rows.where(~(same & F.col("epoch_id").isin(epochs)))
    return rows


def merge_epochs(
    spark: SparkSession, path: str, first: T.StructType, stream: str, before: int, batches: list[int]
) -> None:
    """Put a stream's committed epochs of a batch into one folder once there are MERGE_EPOCHS of them.

    The merged folder is named by the last epoch that it holds, below zero; it appears as a whole, then what it
    replaces is deleted. A merge that was cut short is finished first. Only epochs before `before` are touched.
    """
    schema = stored_schema(spark, path, first)
    for batch in batches:
        folder = f"{path}/batch={batch}/stream={stream}"
        found = epochs_of(spark, folder)
        for number in found.covered:
            delete_path(spark, f"{folder}/epoch_id={number}")
        ready = [e for e in found.single if max(found.merged, default=-1) < e < before]
        if len(ready) < MERGE_EPOCHS:
            continue
        old = [*ready, *(-m - 1 for m in found.merged[-1:])]
        rows = spark.read.schema(schema).option("basePath", path).parquet(*[f"{folder}/epoch_id={n}" for n in old])
        sizes = rows.select("_metadata.file_path", "_metadata.file_size").distinct()
        files = max(1, -(-(sizes.agg(F.sum("file_size")).first()[0] or 0) // FILE_BYTES))
        merged = rows.withColumn("epoch_id", F.lit(-ready[-1] - 1).cast("bigint")).repartition(files)
        writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION)
        writer.parquet(path)
        for number in old:
            delete_path(spark, f"{folder}/epoch_id={number}")


COUNTS = "stream string, epoch_id bigint, rows_read bigint, articles bigint, rows_written bigint"


def write_counts(spark: SparkSession, path: str, stream: str, epoch_id: int, read: int, articles: int, written: int) -> None:
    """One row per epoch; a replayed epoch replaces its own."""
    row = spark.createDataFrame([(stream, epoch_id, read, articles, written)], COUNTS)
    replace_partitions(row, f"{path}/_counts", ["stream", "epoch_id"])


def epoch_counts(spark: SparkSession, path: str) -> DataFrame:
    """stream, epoch_id, rows_read, articles (distinct ones) and rows_written of every epoch."""
    place = f"{path}/_counts"
    if not path_exists(spark, place):
        return spark.createDataFrame([], COUNTS)
    names = [c.split()[0] for c in COUNTS.split(", ")]
    return spark.read.schema(COUNTS).parquet(place).select(names)
