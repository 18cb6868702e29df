"""A training corpus from `documents`: five stages, each written as Parquet before the next reads it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import decontaminate, jaccard_join, line_dedup, quality, sentencepieces
from llm.common import read_table, without
from llm.queries import PIECES, tokenizer_path
from presswork.sources.shared import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from these documents' labels, does not reject."""
    return quality.keep_good(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier one has. One that keeps no line goes; texts without lines stay."""
    return line_dedup.drop_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of near-equal documents."""
    found = jaccard_join.jaccard_components(docs)
    copies = found.where(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    return without(docs, materialize(copies, "copies"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    leaks = decontaminate.find_leaks(docs, read_table(spark, sf_dir, "benchmark"))
    return without(docs, materialize(leaks.select("doc_id").distinct(), "leaks"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    return sentencepieces.encode_documents(docs, tokenizer_path(PIECES))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage is stored before the next one begins."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs


# A classifier trained in numpy and tokenizer libraries have no SQL form; tests hold the stages to brute force.
ORACLE_SQL: str | None = None

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
