"""Layer tables derived by Spark from the given parquet tables.

queue   one row per page and per document: page URLs are in the crawl, document URLs are not
crawl   pages
silver  articles of all queued pages (written once per application and folder, then read)
models  word models over the vocabulary of all documents (written once, then read)
"""

import os
import uuid
import zipfile

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions.constants import EMOTIONS, SENTIMENTS
from presswork.functions.numbers import int_div
from presswork.functions.tokens import tokens
from presswork.functions.urls import remove_urls
from presswork.operators.models import (
    Model,
    emotion_model,
    rule_weights,
    save_model,
    sentiment_model,
)
from presswork.plans.gold import build_gold, write_gold
from presswork.plans.silver import build_silver
from presswork.sources.shared import materialize, new_path, spread
from presswork.sources.tables import read_layer, replace_partitions, store_crawl

LOADED_AT = "2024-01-01 00:00:00"
MODEL_VERSIONS = (1, 2)

_written: dict[tuple[str, str, str], str] = {}


INPUTS = {
    "pages": "page_id bigint, url string, html string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table with its declared schema, so that no file is opened to plan a query."""
    return spark.read.schema(INPUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def subword_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary by rule: what at least five words begin with, and what is inside of as many, of up to three characters."""
    words = documents(spark, sf_dir).select(F.explode(tokens(F.col("text"))).alias("word")).distinct()
    places = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("at"))
    cut = places.select("word", "at", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n"))
    cut = cut.where(F.col("at") + F.col("n") - 1 <= F.length("word"))
    mark = F.when(F.col("at") > 1, "##").otherwise("")
    pieces = cut.select(F.concat(mark, F.substring("word", F.col("at"), F.col("n"))).alias("piece"))
    return pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).where("n >= 5").select("piece")


def loaded_at() -> Column:
    return F.lit(LOADED_AT).cast("timestamp")


def document_url() -> Column:
    """URL of a document, equal for documents of one source, language and length."""
    return F.expr("concat('https://', source, '.example.net/', lang, '/', n_chars)")


def _queue_rows(rows: DataFrame, number: str, batch: str) -> DataFrame:
    return rows.selectExpr(
        f"{number} AS SNo",
        f"{batch} AS batch",
        f"TIMESTAMP '{LOADED_AT}' AS Timestamp",
        "url",
        "CAST(IF(status = 2, 1, 0) AS SMALLINT) AS processed",
        "CAST(status AS SMALLINT) AS status",
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue in mid-work: https pages are downloaded, labelled documents failed, the rest is to do."""
    pages = table(spark, sf_dir, "pages").selectExpr(
        "page_id", "url", "IF(startswith(url, 'https:'), 2, 0) AS status"
    )
    tried = table(spark, sf_dir, "labels").selectExpr("doc_id", "1 AS failed")
    documents = (
        table(spark, sf_dir, "documents")
        .select("doc_id", document_url().alias("url"))
        .join(tried, "doc_id", "left")
        .selectExpr("doc_id", "url", "coalesce(failed, 0) AS status")
    )
    page_rows = _queue_rows(pages, "page_id * 5 + 1", "page_id div 50 + 1")
    return page_rows.unionByName(
        _queue_rows(documents, "doc_id div 4 * 5 + doc_id % 4 + 2", "doc_id div 200 + 1")
    )


def new_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same queue before any work."""
    zero = F.lit(0).cast("smallint")
    return bronze(spark, sf_dir).withColumns({"processed": zero, "status": zero})


def crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def stored_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawl as a table in buckets by URL, written once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, "crawl-table")
    if key not in _written:
        _written[key] = f"crawl_{uuid.uuid4().hex}"
        store_crawl(table(spark, sf_dir, "pages"), _written[key], spark.sparkContext.defaultParallelism)
    return spark.table(_written[key])


def document_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: first line is the title, the other lines are the text."""
    first = F.substring_index("text", "\n", 1)
    rest = F.substr("text", F.length("article_title") + 2)
    return (
        documents(spark, sf_dir)
        .select(
            (F.col("doc_id") + 1).alias("SNo"),
            (int_div(F.col("doc_id"), 200) + 1).cast("int").alias("batch"),
            document_url().alias("url"),
            first.alias("article_title"),
            "text",
        )
        .withColumn("article_text", rest)
        .withColumn("transformed_text", remove_urls(F.col("article_text")))
        .drop("text")
    )


def documents_with_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with URLs of several shapes put around them."""
    return documents(spark, sf_dir).select(
        "doc_id",
        F.concat(
            document_url(), F.lit(" "), "text", F.lit(" ("), document_url(), F.lit(") see "),
            document_url(), F.lit("/more, www."), "source", F.lit(".example.net/"), "lang",
            F.lit(". And "), "source", F.lit(".example.net/"), "lang", F.lit("/x! update:new (a(b)c)"),
        ).alias("text"),
    )


def archives(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder of zip archives with all pages as feed lines, packed by the tasks that hold them.

    Spark has no writer for archives, so tasks write plain files: the shared folder must be mounted. A task that
    runs again puts its archive in the place of the same one.
    """
    folder = new_path(spark, "archives")
    place = folder.removeprefix("file://") if folder.startswith("file:///") else folder.removeprefix("file:")
    if "://" in place:
        raise ValueError("archives are packed into plain files; spark.checkpoint.dir is none")
    fields = [F.col("page_id").cast("string"), F.lit("20240101"), F.lit("1"), F.lit('say "hi'), F.col("url"), F.lit("")]
    lines = spread(table(spark, sf_dir, "pages")).select(F.concat_ws("\t", *fields).alias("value"))

    def pack(frames):
        number = TaskContext.get().partitionId()
        packed = 0
        os.makedirs(place, exist_ok=True)
        own = f"{place}/.{number}-{uuid.uuid4().hex}"
        with zipfile.ZipFile(own, "w", zipfile.ZIP_DEFLATED) as archive, archive.open("feed.csv", "w") as member:
            for frame in frames:
                member.write("".join(f"{v}\n" for v in frame["value"]).encode())
                packed += len(frame)
        os.replace(own, f"{place}/{number}.gkg.csv.zip")
        yield pd.DataFrame({"n": [packed]})

    lines.mapInPandas(pack, "n bigint").agg(F.sum("n")).collect()
    return folder


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = new_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def silver_path(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        rows, _ = build_silver(new_bronze(spark, sf_dir), crawl(spark, sf_dir), loaded_at=loaded_at())
        replace_partitions(rows, path, ["batch"])

    return _once(spark, sf_dir, "silver", write)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_layer(spark, silver_path(spark, sf_dir), "silver")


def model_root(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        text = documents(spark, sf_dir).select(F.explode(tokens(F.col("text"))).alias("token"))
        vocabulary = materialize(text.distinct(), "vocabulary")
        for name, labels in (("sentiment", SENTIMENTS), ("emotion", EMOTIONS)):
            for version in MODEL_VERSIONS:
                save_model(rule_weights(vocabulary, name, version, len(labels)), path, name, version)

    return _once(spark, sf_dir, "models", write)


def models(spark: SparkSession, sf_dir: str) -> list[Model]:
    root = model_root(spark, sf_dir)
    return [sentiment_model(spark, root), emotion_model(spark, root)]


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        write_gold(build_gold(silver(spark, sf_dir), models(spark, sf_dir)), path)

    return read_layer(spark, _once(spark, sf_dir, "gold", write), "gold")
