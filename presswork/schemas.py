"""Explicit schemas of the three layers, and the state codes of the URL queue."""

from pyspark.sql import types as T

# Queue state codes.
TO_DO, DONE = 0, 1
STATUS_DEFAULT, STATUS_NOT_DOWNLOADED, STATUS_DOWNLOADED = 0, 1, 2

BRONZE = T.StructType(
    [
        T.StructField("SNo", T.LongType()),
        T.StructField("batch", T.LongType()),
        T.StructField("Timestamp", T.TimestampType()),
        T.StructField("url", T.StringType()),
        T.StructField("processed", T.ShortType()),
        T.StructField("status", T.ShortType()),
    ]
)

# Result of trying one URL in one run; the queue's flags follow from this log.
FETCH_LOG = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("processed", T.ShortType()),
        T.StructField("status", T.ShortType()),
        T.StructField("run_id", T.LongType()),
    ]
)

# SNo stays BIGINT: numbers past 2^31 are normal at scale.
SILVER = T.StructType(
    [
        T.StructField("SNo", T.LongType()),
        T.StructField("Timestamp", T.TimestampType()),
        T.StructField("url", T.StringType()),
        T.StructField("article_title", T.StringType()),
        T.StructField("article_text", T.StringType()),
        T.StructField("transformed_text", T.StringType()),
        T.StructField("batch", T.IntegerType()),
    ]
)

GOLD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("article", T.StringType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("emotion", T.StringType()),
        T.StructField("batch", T.IntegerType()),
    ]
)

# One row per known token; w holds one integer weight per label of the model.
WEIGHTS = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("w", T.ArrayType(T.IntegerType(), False)),
        T.StructField("model", T.StringType()),
        T.StructField("version", T.IntegerType()),
    ]
)

# Position of each layer's partition column, and its table schema by layer name.
LAYERS = {
    "bronze": (BRONZE, None),
    "silver": (SILVER, "batch"),
    "gold": (GOLD, "batch"),
}
