"""Silver -> gold: label every article, partition by batch."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.urls import article_key
from presswork.operators.batches import latest_batch
from presswork.operators.labels import label_articles
from presswork.operators.models import BROADCAST_BYTES, Model
from presswork.operators.predict import Scorer, predict_labels
from presswork.schemas import GOLD
from presswork.sources.tables import replace_partitions


def gold_input(silver: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """What is scored: key, batch, URL and the cleaned text; and columns to keep."""
    return silver.select(
        article_key(F.col("url")).alias("id"), "batch", "url", F.col("transformed_text").alias("article"), *keep
    )


def build_gold(
    silver: DataFrame, models: Sequence[Model], broadcast_bytes: int = BROADCAST_BYTES, keep: Sequence[str] = ()
) -> DataFrame:
    """Gold rows of every batch of the given silver rows, in one job, with the columns to keep."""
    labelled = label_articles(gold_input(silver, keep), models, ("id", "batch"), "article", broadcast_bytes)
    return labelled.select(*GOLD.names, *keep)


def predict_gold(
    silver: DataFrame,
    make_scorer: Callable[[], Scorer],
    given: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Gold rows from a pluggable scorer: one map over the articles, nothing is shuffled."""
    labelled = predict_labels(gold_input(silver), make_scorer, ["sentiment", "emotion"], "article", given)
    return labelled.select(GOLD.names)


def build_latest_gold(silver: DataFrame, models: Sequence[Model]) -> DataFrame:
    """Gold rows of silver's highest batch."""
    return build_gold(latest_batch(silver), models)


def write_gold(gold: DataFrame, path: str) -> int:
    """Write whole batches; writing a batch again replaces it. Returns the rows written."""
    return replace_partitions(gold, path, ["batch"])
