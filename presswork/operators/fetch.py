"""Fetching as a join: queued URLs against a table of crawled pages (page_id, url, html)."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.functions.html import page_text, page_title
from presswork.functions.urls import remove_urls
from presswork.operators.queue import outcome_flags


def locate_pages(queue: DataFrame, crawl: DataFrame, few: bool = False) -> DataFrame:
    """Queue rows with the page_id of the newest crawl of their URL, null when there is none.

    Crawled URLs are reduced to those in the queue before they are grouped, and grouped on the map side, so
    a URL crawled often is one row per task. `few` says that the queue was measured and fits a broadcast:
    then only its own URLs move. Rows without a URL are set apart and not joined.
    """
    known = queue.where(F.col("url").isNotNull())
    urls = known.select("url").distinct()
    urls = F.broadcast(urls) if few else urls.hint("merge")
    newest = crawl.join(urls, "url", "left_semi").groupBy("url").agg(F.max("page_id").alias("page_id"))
    located = known.join(F.broadcast(newest) if few else newest.hint("merge"), "url", "left")
    kind = crawl.schema["page_id"].dataType
    nameless = queue.where(F.col("url").isNull()).withColumn("page_id", F.lit(None).cast(kind))
    return located.unionByName(nameless)


def fetch_outcomes(located: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Queue flags per tried URL, with the kept columns."""
    return located.select(*keep, "url", *outcome_flags(F.col("page_id").isNotNull()))


def extract_articles(pages: DataFrame, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Title and text of every page, with the kept columns; the raw page goes no further.

    The pair is a generated row, so that a later filter on it reads the extracted values;
    a filter on plain columns would be pushed below and extract everything a second time.
    """
    pair = F.struct(
        page_title(F.col("html")).alias("article_title"),
        page_text(F.col("html")).alias("article_text"),
    )
    return pages.select(*keep, F.inline(F.array(pair)))


def non_empty(articles: DataFrame) -> DataFrame:
    """Articles with both a title and a text."""
    return articles.where((F.col("article_title") != "") & (F.col("article_text") != ""))


def title_without_text(articles: DataFrame) -> DataFrame:
    """Quality check: pages that gave a title but no text."""
    return articles.where((F.col("article_text") == "") & (F.col("article_title") != ""))


def pick_pages(located: DataFrame, crawl: DataFrame, few: bool = False, in_place: bool = False) -> DataFrame:
    """Located rows with the page found for them, as it is; rows without one are left out.

    `few` says that the located rows were measured and fit a broadcast: no page moves then. `in_place` says that
    the crawl is a table in buckets by URL (`store_crawl`): the located rows are dealt like it and no page moves either.
    Otherwise pages and rows meet in a merge join, whose key lets Spark's runtime filter keep unqueued pages from the shuffle.
    """
    found = located.where(F.col("page_id").isNotNull())
    if few:
        joined = crawl.select("page_id", "html").join(F.broadcast(found), "page_id")
    elif in_place:
        # Joined by URL alone, as the buckets are; as a difference the page is no key that would deal both sides anew.
        pages = crawl.select("url", F.col("page_id").alias("_page"), "html")
        joined = pages.join(found.hint("merge"), "url").where(F.col("_page") - F.col("page_id") == 0)
    else:
        joined = crawl.select("page_id", "html").join(found.hint("merge"), "page_id")
    return joined.select(*located.columns, "html")


def articles_of(pages: DataFrame) -> DataFrame:
    """Picked pages with title, text and cleaned text in place of the page; rows that lack either are left out."""
    articles = extract_articles(pages, [c for c in pages.columns if c != "html"])
    return non_empty(articles).withColumn("transformed_text", remove_urls(F.col("article_text")))


def fetch_articles(located: DataFrame, crawl: DataFrame, few: bool = False, in_place: bool = False) -> DataFrame:
    """Located rows with title, text and cleaned text; rows that lack either are left out.

    Pages are picked before they are read, so that only queued ones are parsed.
    """
    return articles_of(pick_pages(located, crawl, few, in_place))


def distinct_articles(articles: DataFrame) -> DataFrame:
    """One row, the lowest-numbered, per URL and content within a batch.

    Rows are compared by digest, so the grouping shuffles keys and not texts. The cleaned text
    follows from the text and needs no digest. SNo must be unique within a batch.
    """
    content = F.md5(F.concat(F.md5("article_title"), F.md5("article_text")))
    kept = (
        articles.select("batch", "url", content.alias("_content"), "SNo")
        .groupBy("batch", "url", "_content")
        .agg(F.min("SNo").alias("SNo"))
    )
    return articles.join(kept.select("batch", "SNo"), ["batch", "SNo"], "left_semi").select(
        articles.columns
    )
