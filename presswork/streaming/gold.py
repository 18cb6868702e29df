"""Silver files as a stream, labelled per micro-batch into a replay-safe gold table."""

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from presswork.functions.urls import article_key
from presswork.operators.batches import one_batch
from presswork.operators.models import Model
from presswork.plans.gold import build_gold
from presswork.schemas import GOLD, SILVER
from presswork.sources.shared import Work, has_files
from presswork.sources.tables import read_layer, replace_partitions
from presswork.streaming.evolving import PARTITION, merge_epochs, merge_schema, read_evolving, write_counts

STORED = T.StructType(
    [*GOLD.fields, T.StructField("stream", T.StringType()), T.StructField("epoch_id", T.LongType())]
)
# Batches of a micro-batch that are named one by one; with more, their range is read.
MOST_LITERALS = 1000
# Largest set of a micro-batch's keys, at KEY_BYTES each, that is sent to every executor.
BROADCAST_BYTES, KEY_BYTES = 64 << 20, 100


def read_silver_stream(
    spark: SparkSession,
    path: str | None = None,
    files_per_trigger: int | None = None,
    batch: int | None = None,
    table: str | None = None,
    more: T.StructType | None = None,
) -> DataFrame:
    """Silver as an unbounded table, all batches or one, from files or from a catalog table.

    `more` names columns that silver has besides its own; gold keeps them.
    """
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    schema = T.StructType([*SILVER.fields, *(more or [])])
    stream = reader.table(table) if table else reader.schema(schema).parquet(path)
    return stream if batch is None else one_batch(stream, batch)


def written_elsewhere(
    keys: DataFrame, path: str, stream: str, epoch_id: int, batches: list[int | None] | None, few: bool
) -> DataFrame:
    """The given keys (batch, _id) that gold has from another epoch or stream, as _batch and _seen.

    Only the batches of the micro-batch are read: they are literals, so that partitions are pruned when the plan is
    made. Without a list of them their range is. `few` says that the keys were measured and fit a broadcast:
    then no row of gold moves.
    """
    spark = keys.sparkSession
    written = read_evolving(spark, path, STORED).where(~((F.col("stream") == stream) & (F.col("epoch_id") == epoch_id)))
    if batches is None:
        low, high = keys.agg(F.min("batch"), F.max("batch")).first()
        near = F.col("batch").between(low, high) | F.col("batch").isNull()
    else:
        near = F.col("batch").isin([b for b in batches if b is not None])
        near = near | F.col("batch").isNull() if None in batches else near
    found = written.where(near).select(F.col("batch").alias("_batch"), F.col("id").alias("_seen"))
    same = F.col("_batch").eqNullSafe(F.col("batch")) & F.col("_seen").eqNullSafe(F.col("_id"))
    return found.join(F.broadcast(keys) if few else keys, same, "left_semi").distinct()


def gold_sink(path: str, models: Sequence[Model], stream: str = "gold") -> Callable[[DataFrame, int], None]:
    """Sink that labels a micro-batch and writes it under the name of its stream and its epoch.

    A replayed epoch overwrites the partitions it wrote before. Articles that gold has from another epoch or
    stream are left out, so rewritten or compacted silver files, which a stream takes
    for new ones, and a stream begun anew add nothing. An article is its batch and URL. Columns that silver
    does not declare are kept and join the stored schema. Committed epochs are merged as they get many.
    """

    def write(rows: DataFrame, epoch_id: int) -> None:
        spark = rows.sparkSession
        keep = [c for c in rows.columns if c not in SILVER.names]
        keyed = rows.withColumn("_id", article_key(F.col("url")))
        with Work(spark, "epoch") as work:
            keys = work.materialize(keyed.groupBy("batch", "_id").agg(F.count(F.lit(1)).alias("_n")), "keys")
            sums = [F.coalesce(F.sum("_n"), F.lit(0)).alias("read"), F.count(F.lit(1)).alias("articles")]
            named = keys.groupBy("batch").agg(*sums).limit(MOST_LITERALS + 1).collect()
            batches = [r["batch"] for r in named] if len(named) <= MOST_LITERALS else None
            whole = named if batches is not None else keys.agg(*sums).collect()
            read, articles = (sum(r[c] for r in whole) for c in ("read", "articles"))
            few = articles * KEY_BYTES <= BROADCAST_BYTES
            fresh = keyed.dropDuplicates(["batch", "_id"])
            if articles and has_files(spark, f"{path}/batch=*"):
                merge_epochs(spark, path, STORED, stream, epoch_id, [b for b in batches or [] if b is not None])
                keys = keys.select("batch", "_id")
                seen = work.materialize(written_elsewhere(keys, path, stream, epoch_id, batches, few), "seen")
                same = F.col("_batch").eqNullSafe(F.col("batch")) & F.col("_seen").eqNullSafe(F.col("_id"))
                fresh = fresh.join(F.broadcast(seen) if few else seen, same, "left_anti")
            gold = build_gold(fresh.drop("_id"), models, keep=keep).withColumns(
                {"stream": F.lit(stream), "epoch_id": F.lit(epoch_id).cast("bigint")}
            )
            merge_schema(spark, path, STORED, gold.schema)
            written = replace_partitions(gold, path, PARTITION) if articles else 0
        write_counts(spark, path, stream, epoch_id, read, articles, written)

    return write


def start_gold_stream(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    models: Sequence[Model],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Label a silver stream into gold. By default all files that are there are taken and the stream stops;
    a trigger such as {"processingTime": "1 minute"} keeps it running. The stream goes by its checkpoint's name."""
    name = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    return (
        silver.writeStream.outputMode("append")
        .foreachBatch(gold_sink(path, models, name))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_gold_stream(spark: SparkSession, path: str) -> DataFrame:
    """Gold rows written by streams, with the columns that were added since; null where a row is older."""
    rows = read_evolving(spark, path, STORED)
    return rows.drop("stream", "epoch_id").select(*GOLD.names, *[c for c in rows.columns if c not in STORED.names])


def read_all_gold(spark: SparkSession, batch_path: str, stream_path: str) -> DataFrame:
    """Gold of batch jobs and of streams as one table."""
    return read_layer(spark, batch_path, "gold").unionByName(read_gold_stream(spark, stream_path), allowMissingColumns=True)
