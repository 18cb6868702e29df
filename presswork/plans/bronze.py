"""Feed -> bronze: number new URLs and append them to the queue."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators.batches import next_batch
from presswork.operators.numbering import dense_number
from presswork.schemas import BRONZE, STATUS_DEFAULT, TO_DO
from presswork.sources.feed import feed_urls, newest_feed_file, stream_archives, unpacked
from presswork.sources.shared import Work, delete_path, has_files, path_exists
from presswork.sources.tables import read_layer, replace_partitions


def bronze_rows(
    urls: DataFrame, bronze: DataFrame, loaded_at: Column | None = None, work: Work | None = None
) -> DataFrame:
    """Queue rows for new URLs: dense number, next batch, load time, flags 0/0.

    Repeated URLs stay; a row id after the URL splits one that fills a large share of the feed.
    """
    tagged = urls.select("url", F.monotonically_increasing_id().alias("_at"))
    numbered = dense_number(tagged, ["url", "_at"], work=work)
    return numbered.select(
        F.col("SNo").cast("bigint").alias("SNo"),
        next_batch(bronze).scalar().alias("batch"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("Timestamp"),
        "url",
        F.lit(TO_DO).cast("smallint").alias("processed"),
        F.lit(STATUS_DEFAULT).cast("smallint").alias("status"),
    )


def import_sink(spark: SparkSession, bronze_path: str, state: str, written: dict[int, int]) -> Callable[[DataFrame, int], None]:
    """Sink that makes a batch of the queue from the archives of an epoch.

    Numbers and batch are stored under the epoch before bronze is touched, so that a replayed epoch finds
    them and writes the same partition again. `written` gets the rows of every epoch.
    """

    def write(archives: DataFrame, epoch_id: int) -> None:
        path = f"{state}/rows/epoch={epoch_id}"
        if not path_exists(spark, f"{path}/_SUCCESS"):
            old = read_layer(spark, bronze_path, "bronze") if has_files(spark, f"{bronze_path}/batch=*") else None
            bronze = spark.createDataFrame([], BRONZE) if old is None else old
            with Work(spark, "import") as work:
                rows = bronze_rows(feed_urls(unpacked(archives)), bronze, work=work)
                rows.write.mode("overwrite").parquet(path)
        stored = spark.read.schema(BRONZE).parquet(path)
        written[epoch_id] = replace_partitions(stored, bronze_path, ["batch"])
        # Older epochs are committed once a later one begins.
        if path_exists(spark, earlier := f"{state}/rows/epoch={epoch_id - 1}"):
            delete_path(spark, earlier)

    return write


def run_import(
    spark: SparkSession, landing: str, bronze_path: str, manifest: str | None = None, archives_per_batch: int = 1000
) -> int:
    """Archives in a landing folder -> their lines -> URLs -> new batches of the queue; returns the rows written.

    An archive, by its path, is taken once, however often the import runs: a file stream keeps what it has seen
    in `_import` below the queue, and an import that was cut short writes the same batch again. With a manifest only the
    archive that it names is listed and opened, by file name, and none if it names none; others stay for later runs.
    The queue is partitioned by batch; one batch comes from at most `archives_per_batch` archives.
    """
    if has_files(spark, f"{bronze_path}/*.parquet"):
        raise ValueError(f"{bronze_path} has rows outside of batch folders: write them with replace_partitions first")
    name = None
    if manifest is not None:
        named = newest_feed_file(spark.read.text(manifest)).select(F.substring_index("file_url", "/", -1).alias("name"))
        name = named.first()["name"]
        if not name:
            return 0
    state = f"{bronze_path}/_import"
    written: dict[int, int] = {}
    stream = stream_archives(spark, landing, name, archives_per_batch)
    started = (
        stream.writeStream.foreachBatch(import_sink(spark, bronze_path, state, written))
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return sum(written.values())
