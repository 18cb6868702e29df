"""News feed: manifest, archives and tab-separated files in a landing folder."""

import io
import re
import zipfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.functions.constants import FEED_SUFFIX, FEED_URL_COLUMN

_LINES_PER_BATCH = 20_000
# Older files are not passed over.
_ANY_AGE = "36500d"


def newest_feed_file(manifest: DataFrame) -> DataFrame:
    """One row, file_url: last word of the first manifest line that names a feed archive, else null.

    A manifest is a single small file, so its rows keep file order under the row id.
    """
    position = F.monotonically_increasing_id()
    line = F.regexp_replace("value", r"\r$", "")
    words = F.split(F.trim(line), r"\s+")
    return (
        manifest.select(line.alias("line"), F.element_at(words, -1).alias("word"), position.alias("at"))
        .where(F.col("line").endswith(FEED_SUFFIX))
        .agg(F.min_by("word", "at").alias("file_url"))
    )


ARCHIVE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def _only(name: str | None) -> str:
    """Pattern of file names: one name as it is written, or all archives."""
    return "*.zip" if name is None else re.sub(r"([\\*?\[\]{}^])", r"\\\1", name)


def unpacked(archives: DataFrame) -> DataFrame:
    """Lines (path, value) of the first member of every archive; one without members has none.

    Archives are spread over tasks; each is unpacked as a stream, a batch of lines at a time.
    """

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist()[:1]:
                        lines = io.TextIOWrapper(archive.open(member), "utf-8", errors="replace", newline="\n")
                        while batch := [ln.rstrip("\r\n") for ln in islice(lines, _LINES_PER_BATCH)]:
                            yield pd.DataFrame({"path": path, "value": batch})

    return archives.select("path", "content").mapInPandas(unpack, "path string, value string")


def read_archives(spark: SparkSession, landing: str, name: str | None = None) -> DataFrame:
    """Lines of the zip archives in a landing folder, or of the one of that name: no other file is opened."""
    reader = spark.read.format("binaryFile").schema(ARCHIVE).option("pathGlobFilter", _only(name))
    return unpacked(reader.load(landing))


def stream_archives(spark: SparkSession, landing: str, name: str | None = None, per_batch: int = 1000) -> DataFrame:
    """The same archives as an unbounded table (path, content): each is given once per checkpoint, whatever its age."""
    reader = spark.readStream.format("binaryFile").schema(ARCHIVE).option("pathGlobFilter", _only(name))
    return reader.option("maxFilesPerTrigger", per_batch).option("maxFileAge", _ANY_AGE).load(landing)


def feed_field(value: Column, position: int) -> Column:
    """Field of a tab-separated line; null when the line is too short or the field is empty."""
    return F.nullif(F.get(F.split(value, "\t"), F.lit(position)), F.lit(""))


def feed_urls(lines: DataFrame) -> DataFrame:
    """URL column of feed lines (column `value`); blank lines are no rows."""
    return lines.where(F.trim("value") != "").select(
        feed_field(F.col("value"), FEED_URL_COLUMN).alias("url")
    )


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """URL column of unpacked feed files: header-less, tab-separated, quotes are plain characters."""
    schema = T.StructType(
        [T.StructField(f"_c{i}", T.StringType()) for i in range(FEED_URL_COLUMN + 1)]
    )
    table = spark.read.csv(path, schema=schema, sep="\t", header=False, quote="", mode="PERMISSIVE")
    return table.select(F.col(f"_c{FEED_URL_COLUMN}").alias("url"))
