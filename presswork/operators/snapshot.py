"""The queue's state as a snapshot: rows with their flags in buckets by URL, and what has come since.

The last outcome of every URL is kept beside the rows, in the same buckets, for rows that are imported later.
A snapshot takes in the outcomes of finished runs and the batches imported meanwhile by rewriting the buckets
that they touch. Its state, stored last, names the runs and the last batch that it holds, so that one that was cut
short is done again: a row keeps the run that gave it its flags, and an older run never replaces a newer one.
"""

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.schemas import BRONZE, FETCH_LOG
from presswork.sources.shared import Work, path_exists, paths_like
from presswork.sources.tables import replace_partitions

BUCKETS = 256
# Largest set of outcomes, at OUTCOME_BYTES besides the URL, that is sent to every executor.
BROADCAST_BYTES, OUTCOME_BYTES = 64 << 20, 60
_BUCKET = T.StructField("bucket", T.IntegerType())
STORED = T.StructType([*BRONZE.fields, T.StructField("run_id", T.LongType()), _BUCKET])
OUTCOMES = T.StructType([*FETCH_LOG.fields, _BUCKET])


@dataclass
class SnapshotState:
    """What a snapshot holds: the runs whose outcomes are in it, and all batches of the queue up to one."""

    buckets: int
    last_batch: int | None
    runs: list[int]


def _number(path: str) -> int:
    return int(path.rsplit("=", 1)[1])


def snapshot_state(spark: SparkSession, path: str, buckets: int = BUCKETS) -> SnapshotState:
    """The last stored state, or that of a snapshot that holds nothing yet."""
    versions = [p for p in paths_like(spark, f"{path}/_state/v=*") if path_exists(spark, f"{p}/_SUCCESS")]
    if not versions:
        return SnapshotState(buckets, None, [])
    return SnapshotState(**json.loads(spark.read.text(max(versions, key=_number)).first()["value"]))


def _store_state(spark: SparkSession, path: str, state: SnapshotState) -> None:
    number = max([0, *map(_number, paths_like(spark, f"{path}/_state/v=*"))]) + 1
    row = spark.createDataFrame([(json.dumps(vars(state)),)], "value string")
    row.coalesce(1).write.text(f"{path}/_state/v={number}")


def new_outcomes(spark: SparkSession, log_path: str, state: SnapshotState) -> tuple[list[int], DataFrame]:
    """The runs that a snapshot does not hold, and the last outcome that they have for every URL.

    Only the log's partitions of these runs are read: they are literals.
    """
    runs = sorted(set(map(_number, paths_like(spark, f"{log_path}/run_id=*"))) - set(state.runs))
    if not runs:
        return [], spark.createDataFrame([], FETCH_LOG)
    tail = spark.read.schema(FETCH_LOG).parquet(log_path).where(F.col("run_id").isin(runs) & F.col("url").isNotNull())
    return runs, _last_per_url(tail)


def _last_per_url(outcomes: DataFrame) -> DataFrame:
    def last(code: str) -> Column:
        return F.max(F.struct("run_id", code))[code].alias(code)

    return outcomes.groupBy("url").agg(last("processed"), last("status"), F.max("run_id").alias("run_id"))


def _bucket(state: SnapshotState) -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(state.buckets)).cast("int")


def _known(spark: SparkSession, path: str, outcomes: DataFrame, buckets: list[int]) -> DataFrame:
    """The last outcome of every URL of some buckets: what the snapshot keeps, and later ones."""
    place = f"{path}/_outcomes"
    if not path_exists(spark, place):
        return outcomes
    kept = spark.read.schema(OUTCOMES).parquet(place).where(F.col("bucket").isin(buckets)).select(FETCH_LOG.names)
    return _last_per_url(kept.unionByName(outcomes))


def _newer(rows: DataFrame, outcomes: DataFrame, few: bool) -> DataFrame:
    """Rows with run_id whose flags are replaced by the outcome of their URL, unless that is of an older run."""
    news = outcomes.select("url", *[F.col(c).alias(f"_{c}") for c in ("processed", "status", "run_id")])
    joined = rows.join(F.broadcast(news) if few else news, "url", "left")
    wins = F.col("_run_id").isNotNull() & (F.col("run_id").isNull() | (F.col("_run_id") >= F.col("run_id")))
    flags = {c: F.when(wins, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("processed", "status", "run_id")}
    return joined.withColumns(flags).select(rows.columns)


def _held(spark: SparkSession, path: str, state: SnapshotState) -> DataFrame:
    """The snapshot's rows that its state vouches for."""
    if state.last_batch is None:
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(path).where(F.col("batch") <= state.last_batch)


def _since(bronze: DataFrame, state: SnapshotState) -> DataFrame:
    """The queue's rows that came after the snapshot, as the snapshot would hold them."""
    rows = bronze.select(BRONZE.names)
    rows = rows if state.last_batch is None else rows.where(F.col("batch") > state.last_batch)
    return rows.withColumns({"run_id": F.lit(None).cast("bigint"), "bucket": _bucket(state)})


def _numbers(buckets: DataFrame) -> list[int]:
    """Bucket numbers, as many as there are buckets at most."""
    return [r["bucket"] for r in buckets.distinct().collect()]


def _few(outcomes: DataFrame) -> bool:
    size = outcomes.agg(F.coalesce(F.sum(F.octet_length("url") + OUTCOME_BYTES), F.lit(0))).first()[0]
    return size <= BROADCAST_BYTES


def queue_from_snapshot(spark: SparkSession, path: str, bronze: DataFrame, log_path: str) -> DataFrame:
    """The queue as it stands, from the snapshot, the batches imported and the runs logged since.

    Neither the log's history nor older batches of the queue are read.
    """
    state = snapshot_state(spark, path)
    runs, outcomes = new_outcomes(spark, log_path, state)
    rows, arrived = _held(spark, path, state), _since(bronze, state)
    if runs:
        rows = _newer(rows, outcomes, _few(outcomes))
    if numbers := _numbers(arrived.select("bucket")):
        known = _known(spark, path, outcomes, numbers)
        rows = rows.unionByName(_newer(arrived, known, _few(known)))
    return rows.select(BRONZE.names)


def advance_snapshot(spark: SparkSession, path: str, bronze: DataFrame, log_path: str, buckets: int = BUCKETS) -> int:
    """Take finished runs and new batches into the snapshot; returns the rows that were rewritten.

    Only buckets with a new row or an outcome are read and written, each as a whole. Runs must be complete when
    they are taken in, and batches when they are seen. One writer at a time; the number of buckets is that of the first call.
    """
    state = snapshot_state(spark, path, buckets)
    runs, outcomes = new_outcomes(spark, log_path, state)
    written = 0
    with Work(spark, "snapshot") as work:
        outcomes = work.materialize(outcomes, "outcomes")
        arrived = work.materialize(_since(bronze, state), "arrived")
        own = _bucket(state).alias("bucket")
        if numbers := _numbers(arrived.select("bucket").unionAll(outcomes.select(own))):
            known = work.materialize(_known(spark, path, outcomes, numbers), "known")
            rows = _held(spark, path, state).where(F.col("bucket").isin(numbers)).unionByName(arrived)
            merged = work.materialize(_newer(rows, known, _few(known)), "merged")
            written = replace_partitions(merged, path, ["bucket"])
            replace_partitions(known.select(*FETCH_LOG.names, own), f"{path}/_outcomes", ["bucket"])
        last = arrived.agg(F.max("batch")).first()[0]
    if runs or last is not None:
        batch = state.last_batch if last is None else last
        _store_state(spark, path, SnapshotState(state.buckets, batch, [*state.runs, *runs]))
    return written
