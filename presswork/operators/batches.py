"""Batch numbers: next, latest, per-batch counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def max_batch(table: DataFrame) -> DataFrame:
    return table.agg(F.max("batch").alias("max_batch"))


def next_batch(table: DataFrame) -> DataFrame:
    """One row: highest batch + 1, or 1 for an empty table."""
    return table.agg(F.coalesce(F.max("batch") + 1, F.lit(1)).cast("bigint").alias("next_batch"))


def distinct_batches(table: DataFrame) -> DataFrame:
    return table.select("batch").distinct()


def rows_per_batch(table: DataFrame) -> DataFrame:
    return table.groupBy("batch").agg(F.count(F.lit(1)).alias("n_rows"))


def latest_batch(table: DataFrame) -> DataFrame:
    """Rows of the highest batch; on a table partitioned by batch, only that partition is read."""
    return table.where(F.col("batch") == max_batch(table).scalar())


def latest_batch_lookup(table: DataFrame, url: Column) -> DataFrame:
    """Rows of one URL in the highest batch."""
    newest = max_batch(table).select(F.col("max_batch").alias("batch"))
    return table.where(F.col("url") == url).join(newest, "batch", "left_semi")


def one_batch(table: DataFrame, batch: int) -> DataFrame:
    return table.where(F.col("batch") == batch)
