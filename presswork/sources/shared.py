"""The folder every executor can reach, and frames written to it to cut lineage."""

import atexit
import shutil
import tempfile
import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession

# Largest table, by Spark's own estimate, that is dealt out anew because it has fewer splits than cores.
SPREAD_BYTES = 128 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; where that is unset, on one machine only, a temporary one
    that goes when the program ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    own = tempfile.mkdtemp(prefix="presswork-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/presswork/{label}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _hadoop(spark, path)
    return files.exists(place)


def mounted_path(spark: SparkSession, path: str) -> str | None:
    """The plain path of what lies in a file system of the machine, None for a store that only Spark reads."""
    files, place = _hadoop(spark, path)
    uri = files.makeQualified(place).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def paths_like(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern."""
    files, place = _hadoop(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(place) or []]


def has_files(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches a pattern."""
    return bool(paths_like(spark, pattern))


def delete_path(spark: SparkSession, path: str) -> None:
    files, place = _hadoop(spark, path)
    files.delete(place, True)


class Mover:
    """Marks folders and moves them into place. What it needs of the JVM is fetched once, for a great many of them."""

    def __init__(self, spark: SparkSession):
        self._path, self._settings = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._path(path)
        return place.getFileSystem(self._settings), place

    def touch(self, path: str) -> None:
        """An empty file, with the folders above it where they lack."""
        files, place = self._at(path)
        files.create(place, True).close()

    def move(self, source: str, target: str) -> None:
        """Put a folder in the place of one that may stand there; both lie in one file system, so no row is copied."""
        files, place = self._at(target)
        files.delete(place, True)
        files.mkdirs(place.getParent())
        if not files.rename(self._path(source), place):
            raise OSError(f"{source} was not moved to {target}")


def spread(df: DataFrame) -> DataFrame:
    """Give every core work when a small stored table has fewer splits than cores.

    Only a table that is small by estimate is moved; larger ones have splits of their own.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if size <= SPREAD_BYTES and df.rdd.getNumPartitions() < cores else df


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: lost executors cost no recomputation."""
    return _stored(df, new_path(df.sparkSession, label), partition_by)


def _stored(df: DataFrame, path: str, partition_by: str | None, rows_per_file: int = 0) -> DataFrame:
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Work:
    """Frames stored for the length of a flow: `with Work(spark) as work: work.materialize(...)`.

    They lie in the shared folder, or at `path`, for what is moved to a table and so has to be in its file system.
    """

    def __init__(self, spark: SparkSession, label: str = "work", path: str | None = None):
        self.spark, self.path = spark, path or new_path(spark, label)

    def __enter__(self) -> "Work":
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        delete_path(self.spark, self.path)

    def materialize(
        self, df: DataFrame, label: str, partition_by: str | None = None, rows_per_file: int = 0
    ) -> DataFrame:
        """`rows_per_file` makes files small enough for several tasks to share a partition."""
        return _stored(df, f"{self.path}/{label}-{uuid.uuid4().hex}", partition_by, rows_per_file)
