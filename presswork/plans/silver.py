"""Bronze -> silver: queue -> pages -> clean articles, and the outcome of every tried URL."""

import time
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.constants import BATCH_ROWS, CHUNK_ROWS
from presswork.functions.numbers import int_div
from presswork.operators.fetch import articles_of, fetch_articles, fetch_outcomes, locate_pages, pick_pages
from presswork.operators.numbering import dense_number
from presswork.operators.queue import apply_outcomes, latest_outcome, work_queue
from presswork.operators.snapshot import advance_snapshot, queue_from_snapshot
from presswork.schemas import FETCH_LOG, SILVER
from presswork.sources.shared import Mover, Work, path_exists, paths_like
from presswork.sources.tables import balanced, read_layer, replace_partitions, store_folders


# Largest queue, URLs and 100 bytes per row, that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

# URLs whose articles a chunked run makes in one job, ahead of their commits; with a rate, those of so many seconds.
AHEAD_URLS, AHEAD_SECONDS = 100_000, 10
# Pages of one stored file, so that all cores share the pages of such a job.
PAGES_PER_FILE = 1000


def is_few(queue: DataFrame, max_bytes: int) -> bool:
    """Whether a stored queue is small enough to send to every executor."""
    size = F.sum(F.coalesce(F.octet_length("url"), F.lit(0)) + 100)
    return queue.agg(F.coalesce(size, F.lit(0))).first()[0] <= max_bytes


def numbered_queue(
    bronze: DataFrame,
    silver: DataFrame | None = None,
    chunk_size: int = CHUNK_ROWS,
    work: Work | None = None,
) -> DataFrame:
    """Distinct queued URLs with their number in this run and the silver batch they go to.

    Every chunk of `chunk_size` URLs is one batch, numbered on from silver's highest. Only
    URLs and numbers move here. Rows without a URL are not fetched.
    """
    named = work_queue(bronze).where(F.col("url").isNotNull())
    todo = named.groupBy("url").agg(F.min("SNo").alias("_first"))
    numbered = dense_number(todo, ["_first", "url"], work=work)
    chunk = int_div(F.col("SNo") - 1, chunk_size)
    base = F.lit(0) if silver is None else silver.agg(F.coalesce(F.max("batch"), F.lit(0))).scalar()
    return numbered.select("SNo", (chunk + 1 + base).cast("int").alias("batch"), "url")


def _silver_rows(
    located: DataFrame, crawl: DataFrame, few: bool, loaded_at: Column | None, in_place: bool = False
) -> DataFrame:
    at = F.current_timestamp() if loaded_at is None else loaded_at
    return fetch_articles(located, crawl, few, in_place).withColumn("Timestamp", at).select(SILVER.names)


def build_silver(
    bronze: DataFrame,
    crawl: DataFrame,
    silver: DataFrame | None = None,
    chunk_size: int = CHUNK_ROWS,
    loaded_at: Column | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    in_place: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Silver rows of all queued URLs, and the outcome (url, processed, status) of each.

    `in_place` says that the crawl is a table in buckets by URL, which is read without moving a page."""
    queue = numbered_queue(bronze, silver, chunk_size)
    few = is_few(queue, broadcast_bytes)
    located = locate_pages(queue, crawl, few)
    return _silver_rows(located, crawl, few, loaded_at, in_place), fetch_outcomes(located)


def current_queue(bronze: DataFrame, log: DataFrame) -> DataFrame:
    """The queue as it stands: imported rows with the flags of the last run that tried their URL."""
    return apply_outcomes(bronze, latest_outcome(log))


def _numbering(
    bronze: DataFrame,
    silver: DataFrame | None,
    log_path: str,
    run_id: int,
    chunk_size: int,
    work: Work,
    snapshot: str | None = None,
) -> DataFrame:
    """The run's queue, from the store beside the log if the run was begun before."""
    spark = bronze.sparkSession
    # A name with an underscore in front is no part of the log to Spark's readers.
    path = f"{log_path}/_numbering/run_id={run_id}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        if snapshot is not None:
            bronze = queue_from_snapshot(spark, snapshot, bronze, log_path)
        elif path_exists(spark, log_path):
            log = spark.read.schema(FETCH_LOG).parquet(log_path)
            bronze = current_queue(bronze, log.where(F.col("run_id") != run_id))
        numbered_queue(bronze, silver, chunk_size, work).write.mode("overwrite").parquet(path)
    return spark.read.schema("SNo bigint, batch int, url string").parquet(path)


def run_silver(
    bronze: DataFrame,
    crawl: DataFrame,
    silver_path: str,
    log_path: str,
    run_id: int,
    silver: DataFrame | None = None,
    chunk_size: int = BATCH_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    snapshot: str | None = None,
    in_place: bool = False,
) -> dict[str, int]:
    """Fetch what is still to do into silver and log every outcome; returns the rows written to each.

    The numbers and batches of a run are stored under its run_id before anything else is written. A
    rerun, whatever has been written meanwhile, finds them and writes the same batches and log partition
    again. `silver` is the table that batches are numbered on from, in a first run. What earlier runs tried is left out.
    `in_place` is for a crawl in buckets by URL.
    With a `snapshot` of the queue that is known from there and from the runs since, and this run is taken in at the end.
    """
    spark = bronze.sparkSession
    if silver is None and path_exists(spark, silver_path):
        silver = read_layer(spark, silver_path, "silver")
    with Work(spark, "silver-run") as work:
        queue = _numbering(bronze, silver, log_path, run_id, chunk_size, work, snapshot)
        few = is_few(queue, broadcast_bytes)
        located = work.materialize(locate_pages(queue, crawl, few), "located")
        written = replace_partitions(_silver_rows(located, crawl, few, None, in_place), silver_path, ["batch"])
        log = fetch_outcomes(located).withColumn("run_id", F.lit(run_id).cast("bigint"))
        tried = replace_partitions(log, log_path, ["run_id"])
    if snapshot is not None:
        advance_snapshot(spark, snapshot, bronze, log_path)
    return {"silver": written, "log": tried}


@dataclass
class ChunkedRun:
    """How far a chunked run has come: commits made by this call and in all, those planned, and the rows written by this call."""

    commits: int
    done: int
    planned: int
    silver: int
    log: int


def _staged(queue: DataFrame, crawl: DataFrame, work: Work, broadcast_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Located rows and the pages found, stored by stretch: each reads its own folder, and neither queue nor crawl."""
    few = is_few(queue, broadcast_bytes)

    def store(rows: DataFrame, label: str, rows_per_file: int = 0) -> DataFrame:
        return work.materialize(balanced(rows, ["stretch"]), label, "stretch", rows_per_file)

    located = store(locate_pages(queue, crawl, few), "located")
    return located, store(pick_pages(located, crawl, few), "pages", PAGES_PER_FILE)


def run_silver_chunks(
    bronze: DataFrame,
    crawl: DataFrame,
    silver_path: str,
    log_path: str,
    run_id: int,
    silver: DataFrame | None = None,
    chunk_size: int = CHUNK_ROWS,
    chunks_per_commit: int = 1,
    most_commits: int | None = None,
    urls_per_second: float | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> ChunkedRun:
    """As run_silver, chunk by chunk: articles, then outcomes of some chunks are in place before any of the next ones.

    Between commits the queue's state is that of the log, so what was tried is seen by every reader. A run
    that stopped, by `most_commits` or by a failure, is resumed by the same run_id: its stored numbering is read
    again and committed chunks are passed over; one that was cut short is written anew as a whole. With `urls_per_second`
    commits are spaced so that no more URLs than that are tried on average. Without a need for state
    between chunks or for a rate, run_silver does the same in one job. Queue and crawl meet once in a call, whatever
    the number of its commits: the pages that it will read, still unread, are stored by stretch. The commits of a stretch
    have their files made in one job, beside the tables and unseen by their readers; a commit moves its own into place.
    """
    spark = bronze.sparkSession
    if silver is None and path_exists(spark, silver_path):
        silver = read_layer(spark, silver_path, "silver")
    made = rows = logged = 0
    # Names with an underscore in front are no part of a table to Spark's readers.
    ready, tried_ready = f"{silver_path}/_ready-{run_id}", f"{log_path}/_ready-{run_id}"
    with Work(spark, "chunked-run") as work, Work(spark, path=ready), Work(spark, path=tried_ready):
        queue = _numbering(bronze, silver, log_path, run_id, chunk_size, work)
        first, last = queue.agg(F.min("batch"), F.max("batch")).first()
        starts = [] if first is None else list(range(first, last + 1, chunks_per_commit))
        # Folders below a run's partition carry no column; each is one commit, complete or not there.
        folder = f"{log_path}/run_id={run_id}/chunks-"
        committed = paths_like(spark, f"{folder}*/_SUCCESS")
        taken = {int(path.split("/")[-2].removeprefix("chunks-")) for path in committed}
        todo = [start for start in starts if start not in taken]
        done = len(starts) - len(todo)
        chosen = todo[:most_commits]
        ahead = min(AHEAD_URLS, urls_per_second * AHEAD_SECONDS) if urls_per_second else AHEAD_URLS
        # Batches of a stretch.
        width = chunks_per_commit * max(1, int(ahead // (chunk_size * chunks_per_commit)))
        if chosen:
            since = F.col("batch") - chosen[0]
            planned = queue.where(F.col("batch").between(chosen[0], chosen[-1] + chunks_per_commit - 1))
            planned = planned.withColumn("stretch", int_div(since, width).cast("int"))
            located, pages = _staged(planned, crawl, work, broadcast_bytes)
            # Put together once: a stretch only adds which folder it reads.
            articles = articles_of(pages).withColumn("Timestamp", F.current_timestamp())
            commit = (int_div(since, chunks_per_commit) * chunks_per_commit + chosen[0]).cast("int")
            outcomes = fetch_outcomes(located.withColumn("commit", commit), ["stretch", "commit"])
            # Outcomes are narrow: those of several commits would all go to one task, a file for each.
            several, cores = width > chunks_per_commit, spark.sparkContext.defaultParallelism
            dealt = outcomes.repartition(cores, "commit") if several else balanced(outcomes, ["commit"])
        mover, began = Mover(spark), time.monotonic()
        for stretch, mine in groupby(chosen, lambda start: (start - chosen[0]) // width):
            here = F.col("stretch") == stretch
            found = store_folders(balanced(articles.where(here).select(SILVER.names), ["batch"]), ready, "batch")
            tried = store_folders(dealt.where(here).drop("stretch"), tried_ready, "commit")
            for start in mine:
                for batch in range(start, start + chunks_per_commit):
                    if batch in found:
                        mover.move(f"{ready}/batch={batch}", f"{silver_path}/batch={batch}")
                        rows += found[batch]
                # The file that makes a commit comes with its rows.
                mover.touch(f"{tried_ready}/commit={start}/_SUCCESS")
                mover.move(f"{tried_ready}/commit={start}", f"{folder}{start}")
                for path in (silver_path, log_path):
                    spark.catalog.refreshByPath(path)
                made, logged = made + 1, logged + tried.get(start, 0)
                if urls_per_second and made < len(todo):
                    time.sleep(max(0.0, tried.get(start, 0) / urls_per_second - (time.monotonic() - began)))
                began = time.monotonic()
    return ChunkedRun(made, done + made, len(starts), rows, logged)
