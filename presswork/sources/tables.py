"""Layer tables: create, read, append, replace partitions, compact, report."""

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.schemas import LAYERS

# Size of a file that compaction aims at.
FILE_BYTES = 256 * 1024 * 1024


def create_layer_table(
    spark: SparkSession,
    name: str,
    layer: str,
    replace: bool = False,
    location: str | None = None,
    buckets: int | None = None,
) -> None:
    """Create a Parquet table for a layer: partitioned by batch, optionally external or bucketed.

    Bucketing by url lets later joins on url read both sides in place.
    """
    schema, partition = LAYERS[layer]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    if replace:
        drop_layer_table(spark, name)
    clauses = [f"CREATE TABLE {name} ({columns}) USING parquet"]
    if partition:
        clauses.append(f"PARTITIONED BY ({partition})")
    if buckets:
        clauses.append(f"CLUSTERED BY (url) INTO {buckets} BUCKETS")
    if location:
        clauses.append(f"LOCATION '{location}'")
    spark.sql(" ".join(clauses))


def store_crawl(crawl: DataFrame, name: str, buckets: int, append: bool = False) -> DataFrame:
    """Store crawled pages as a catalog table in buckets by URL, sorted in each, and return it.

    Pages are shuffled once, here; every later look-up reads them in place. A bucket should fit a task: a URL that
    was crawled very often fills one, so many buckets help only among URLs.
    """
    mode = "append" if append else "overwrite"
    dealt = crawl.repartition(buckets, "url")
    dealt.write.mode(mode).format("parquet").bucketBy(buckets, "url").sortBy("url").saveAsTable(name)
    return crawl.sparkSession.table(name)


def drop_layer_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_layer(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """Layer files at a path, with the declared schema and column order: nothing is inferred."""
    schema = LAYERS[layer][0]
    return spark.read.schema(schema).parquet(path).select(schema.names)


def balanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Gather each output partition into few files; AQE splits the partitions that are large."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Rows of a write, counted while it runs."""
    written = Observation()
    write(df.observe(written, F.count(F.lit(1)).alias("rows")))
    try:
        return written.get["rows"]
    except Py4JJavaError:
        # A plan that is found empty before it runs observes nothing.
        if df.isEmpty():
            return 0
        raise


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> int:
    """Write whole partitions; a rerun replaces the ones it writes and leaves the others alone.
    Returns the rows written."""

    return _counted(df, lambda rows: _write_partitions(balanced(rows, partition_by), path, partition_by))


def _write_partitions(rows: DataFrame, path: str, partition_by: list[str]) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def compact_partition(
    spark: SparkSession, path: str, schema: T.StructType, column: str, value: int, file_bytes: int = FILE_BYTES
) -> int:
    """Rewrite one partition into files of about `file_bytes`; returns how many were planned.

    The partition's size is read from the file listing, so a large one goes through many tasks.
    """
    rows = spark.read.schema(schema).parquet(path).where(F.col(column) == value)
    sizes = rows.select("_metadata.file_path", "_metadata.file_size").distinct()
    size = sizes.agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0]
    files = max(1, -(-size // file_bytes))
    (
        rows.repartition(files)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    return files


def store_folders(df: DataFrame, path: str, by: str) -> dict[int, int]:
    """Write a path anew with a folder for each value of `by`; returns the rows in each."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(by).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return {row[by]: row["count"] for row in stored.groupBy(by).count().collect()}


def append_counted(df: DataFrame, path: str, partition_by: list[str]) -> int:
    """Append rows and return how many, counted while they are written."""
    return _counted(df, lambda rows: rows.write.mode("append").partitionBy(*partition_by).parquet(path))


def write_table(df: DataFrame, name: str, layer: str) -> int:
    """Write rows to a catalog table of a layer: partitions are replaced and registered, a table
    without any is appended to, buckets are kept. Returns the rows written."""
    schema, partition = LAYERS[layer]
    ordered = df.select(schema.names)
    if partition is None:
        return _counted(ordered, lambda rows: rows.write.mode("append").insertInto(name))
    spark = df.sparkSession
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        return _counted(balanced(ordered, [partition]), lambda rows: rows.write.mode("overwrite").insertInto(name))
    finally:
        spark.conf.set(setting, before)


def write_report(spark: SparkSession, action: str, rows: int) -> DataFrame:
    """One row about a write: its row count and a message."""
    # The wording of the two messages.
    message = f"Successfully {action} {rows} records" if rows > 0 else "No updates performed"
    return spark.createDataFrame([(rows, message)], "n_rows bigint, message string")
