"""Linear word models as versioned tables: save, load, and the size check before a broadcast."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions.constants import EMOTIONS, SENTIMENTS
from presswork.schemas import WEIGHTS

# Largest model, as counted by `weights_size`, that is sent to every executor.
BROADCAST_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class Model:
    """Name of the label column, class names in order, weights (token, w) and their size in bytes."""

    name: str
    labels: Sequence[str]
    weights: DataFrame
    size: int | None = None


def rule_weights(tokens: DataFrame, model: str, version: int, n_labels: int) -> DataFrame:
    """Weights (-3..3) of a stand-in model: hex digit i of an MD5 is the weight of class i."""
    seed = F.md5(F.concat(F.lit(f"{model}:{version}:"), "token"))

    def weight(i: int) -> Column:
        digit = F.instr(F.lit("0123456789abcdef"), F.substring("_seed", i + 1, 1)) - 1
        return (digit % 7 - 3).cast("int")

    return tokens.select("token", seed.alias("_seed")).select(
        "token", F.array(*[weight(i) for i in range(n_labels)]).alias("w")
    )


def save_model(weights: DataFrame, root: str, model: str, version: int) -> None:
    """Store a version of a model; saving it again replaces it, other versions stay."""
    (
        weights.select("token", "w", F.lit(model).alias("model"), F.lit(version).alias("version"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model", "version")
        .parquet(root)
    )


def load_model(
    spark: SparkSession, root: str, model: str, version: int | None = None
) -> DataFrame:
    """Weights of one version, the newest by default; only its files are read."""
    stored = spark.read.schema(WEIGHTS).parquet(root).where(F.col("model") == model)
    wanted = F.lit(version) if version is not None else stored.agg(F.max("version")).scalar()
    return stored.where(F.col("version") == wanted)


def weights_size(n_labels: int) -> Column:
    """Aggregate: bytes of a weights table in memory: words, weights and 64 bytes per row."""
    return F.coalesce(F.sum(F.octet_length("token") + (64 + 4 * n_labels)), F.lit(0))


def open_model(
    spark: SparkSession, root: str, name: str, labels: Sequence[str], version: int | None = None
) -> Model:
    """A stored model ready to score with, the newest version by default.

    One small job lists versions with their sizes; scoring then reads a fixed version and
    knows how large it is.
    """
    stored = spark.read.schema(WEIGHTS).parquet(root).where(F.col("model") == name)
    chosen = stored.where(F.col("version") == version) if version is not None else stored
    sizes = chosen.groupBy("version").agg(weights_size(len(labels)).alias("size"))
    newest = sizes.orderBy(F.desc("version")).first()
    if newest is None:
        raise ValueError(f"no such version of model {name} under {root}")
    weights = stored.where(F.col("version") == newest["version"])
    return Model(name, labels, weights, newest["size"])


def sentiment_model(spark: SparkSession, root: str, version: int | None = None) -> Model:
    return open_model(spark, root, "sentiment", SENTIMENTS, version)


def emotion_model(spark: SparkSession, root: str, version: int | None = None) -> Model:
    return open_model(spark, root, "emotion", EMOTIONS, version)


def model_size(model: Model) -> int:
    if model.size is not None:
        return model.size
    return model.weights.agg(weights_size(len(model.labels))).first()[0]


def fits_broadcast(models: Sequence[Model], max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether models are together small enough to send to every executor."""
    return sum(model_size(model) for model in models) <= max_bytes
