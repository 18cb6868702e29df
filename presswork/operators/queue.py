"""URL queue: what to fetch, what came back, and the queue's state after it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.schemas import (
    DONE,
    STATUS_DEFAULT,
    STATUS_DOWNLOADED,
    STATUS_NOT_DOWNLOADED,
    TO_DO,
)


def work_queue(bronze: DataFrame) -> DataFrame:
    """Rows not tried yet; a URL that failed once is not retried."""
    return bronze.where((F.col("processed") == TO_DO) & (F.col("status") == STATUS_DEFAULT))


def done_rows(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("processed") == DONE)


def failed_rows(bronze: DataFrame) -> DataFrame:
    return bronze.where(
        (F.col("processed") == TO_DO) & (F.col("status") == STATUS_NOT_DOWNLOADED)
    )


def queue_head(bronze: DataFrame, rows: int) -> DataFrame:
    """First rows of the queue by batch and, as numbers start anew in each, by number."""
    return work_queue(bronze).orderBy("batch", "SNo", "url").limit(rows)


def status_breakdown(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("processed", "status").agg(F.count(F.lit(1)).alias("n_rows"))


def outcome_flags(found: Column) -> list[Column]:
    """Queue flags of a fetch: (done, downloaded) when found, else (to do, not downloaded)."""
    processed = F.when(found, DONE).otherwise(TO_DO)
    status = F.when(found, STATUS_DOWNLOADED).otherwise(STATUS_NOT_DOWNLOADED)
    return [processed.cast("smallint").alias("processed"), status.cast("smallint").alias("status")]


def outcome_per_url(outcomes: DataFrame) -> DataFrame:
    """Highest flags seen per URL, combined on the map side before the shuffle."""
    return outcomes.groupBy("url").agg(
        F.max("processed").alias("processed"), F.max("status").alias("status")
    )


def latest_outcome(log: DataFrame) -> DataFrame:
    """Highest flags per URL within the last run that tried it; any run id is in order."""

    def in_last_run(code: str) -> Column:
        return F.max(F.struct("run_id", code))[code].alias(code)

    return log.groupBy("url").agg(in_last_run("processed"), in_last_run("status"))


def touched_rows(bronze: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Queue rows whose URL has an outcome."""
    urls = outcomes.where(F.col("url").isNotNull()).select("url").distinct()
    return bronze.join(urls, "url", "left_semi").select(bronze.columns)


def apply_outcomes(bronze: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Queue with its flags replaced by the outcome of each URL; other rows keep theirs."""
    news = outcome_per_url(outcomes.where(F.col("url").isNotNull())).select(
        "url",
        F.col("processed").alias("_processed"),
        F.col("status").alias("_status"),
        F.lit(True).alias("_hit"),
    )
    flags = {
        "processed": F.when(F.col("_hit"), F.col("_processed")).otherwise(F.col("processed")),
        "status": F.when(F.col("_hit"), F.col("_status")).otherwise(F.col("status")),
    }
    return bronze.join(news, "url", "left").withColumns(flags).select(bronze.columns)
