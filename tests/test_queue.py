import pytest
from pyspark.sql import functions as F

from presswork.operators import batches, queue
from presswork.operators.fetch import (
    distinct_articles,
    fetch_articles,
    fetch_outcomes,
    locate_pages,
    non_empty,
    title_without_text,
)
from presswork.operators.numbering import chunk_rows, dense_number
from presswork.plans.bronze import bronze_rows
from presswork.schemas import BRONZE, FETCH_LOG

QUEUE = "SNo bigint, batch bigint, url string, processed smallint, status smallint"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def bronze(spark):
    return spark.createDataFrame(
        [(1, 1, "a", 0, 0), (2, 1, "b", 0, 0), (3, 1, "b", 0, 0), (4, 2, "c", 0, 1), (5, 2, "d", 1, 2),
         (6, 2, None, 0, 0)],
        QUEUE,
    )


def test_queue_states(bronze):
    numbers = lambda df: sorted(r["SNo"] for r in df.collect())
    assert numbers(queue.work_queue(bronze)) == [1, 2, 3, 6]
    assert numbers(queue.failed_rows(bronze)) == [4]
    assert numbers(queue.done_rows(bronze)) == [5]
    assert [r["SNo"] for r in queue.queue_head(bronze, 2).collect()] == [1, 2]
    assert rows_of(queue.status_breakdown(bronze)) == [(0, 0, 4), (0, 1, 1), (1, 2, 1)]


def test_outcomes_replace_flags_and_leave_the_rest(spark, bronze):
    outcomes = spark.createDataFrame(
        [("b", 0, 1), ("b", 1, 2), ("d", 0, 1), ("x", 1, 2)], "url string, processed smallint, status smallint"
    )
    updated = {r["SNo"]: (r["processed"], r["status"]) for r in queue.apply_outcomes(bronze, outcomes).collect()}
    assert updated == {1: (0, 0), 2: (1, 2), 3: (1, 2), 4: (0, 1), 5: (0, 1), 6: (0, 0)}
    assert sorted(r["SNo"] for r in queue.touched_rows(bronze, outcomes).collect()) == [2, 3, 5]


def test_later_run_wins_over_higher_flags(spark):
    log = spark.createDataFrame([("a", 1, 2, 1), ("a", 0, 1, 2), ("b", 0, 1, 1), ("b", 1, 0, 1)], FETCH_LOG)
    assert rows_of(queue.latest_outcome(log)) == [("a", 0, 1), ("b", 1, 1)]


def test_batches(spark, bronze):
    empty = spark.createDataFrame([], BRONZE)
    assert batches.next_batch(empty).first()[0] == 1
    assert batches.next_batch(bronze).first()[0] == 3
    assert sorted(r["SNo"] for r in batches.latest_batch(bronze).collect()) == [4, 5, 6]
    assert [r["SNo"] for r in batches.latest_batch_lookup(bronze, F.lit("d")).collect()] == [5]
    assert batches.latest_batch_lookup(bronze, F.lit("a")).count() == 0
    assert rows_of(batches.rows_per_batch(bronze)) == [(1, 3), (2, 3)]
    assert rows_of(batches.distinct_batches(bronze)) == [(1,), (2,)]
    assert [r["SNo"] for r in batches.one_batch(bronze, 1).collect()] == [1, 2, 3]


def test_fetch_takes_newest_page_and_reports_missing(spark, bronze):
    page = "<title>{0}</title><article>{0} http://x.org/ab.</article>"
    crawl = spark.createDataFrame(
        [(1, "a", page.format("old")), (9, "a", page.format("new")), (2, "b", "<article>no title</article>"),
         (3, "z", page.format("z"))],
        "page_id bigint, url string, html string",
    )
    located = locate_pages(queue.work_queue(bronze).select("url").distinct(), crawl)
    assert rows_of(fetch_outcomes(located)) == [("a", 1, 2), ("b", 1, 2), (None, 0, 1)]
    [article] = fetch_articles(located, crawl).collect()
    assert (article["url"], article["article_title"]) == ("a", "new")
    assert (article["article_text"], article["transformed_text"]) == ("new http://x.org/ab.", "new .")


def test_empty_articles_and_repeats(spark):
    rows = [
        (1, 1, "u", "t", "x", "x"), (2, 1, "u", "t", "x", "x"), (3, 1, "u", "t", "y", "y"),
        (4, 2, "u", "t", "x", "x"), (5, 1, "v", "", "x", "x"), (6, 1, "v", "t", "", ""),
        (7, 1, "v", None, "x", "x"), (8, 1, "v", "t", None, None),
    ]
    names = "SNo bigint, batch int, url string, article_title string, article_text string, transformed_text string"
    staged = spark.createDataFrame(rows, names)
    assert sorted(r["SNo"] for r in distinct_articles(non_empty(staged)).collect()) == [1, 3, 4]
    assert [r["SNo"] for r in title_without_text(staged).collect()] == [6]


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_dense_numbers_do_not_depend_on_partitions(spark, partitions):
    frame = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id"
    )
    numbered = dense_number(frame.repartition(partitions), ["k", "id"]).orderBy("SNo").collect()
    expected = sorted(((r["k"], r["id"]) for r in frame.collect()))
    assert [(r["k"], r["id"]) for r in numbered] == expected
    assert [r["SNo"] for r in numbered] == list(range(1, 1001))


@pytest.mark.parametrize("n", [0, 1, 499, 500, 501, 1000, 1001])
def test_chunks_are_disjoint_and_complete(spark, n):
    rows = chunk_rows(spark.range(n), ["id"]).collect()
    assert sorted(r["id"] for r in rows) == list(range(n))
    assert all(r["chunk_id"] == r["id"] // 500 for r in rows)


def test_import_numbers_new_rows_and_keeps_repeats(spark, bronze):
    urls = spark.createDataFrame([("n",), ("m",), ("n",), (None,)], "url string")
    rows = bronze_rows(urls, bronze).collect()
    assert sorted(r["SNo"] for r in rows) == [1, 2, 3, 4]
    assert {(r["batch"], r["processed"], r["status"]) for r in rows} == {(3, 0, 0)}
    assert sorted(str(r["url"]) for r in rows) == ["None", "m", "n", "n"]
    assert all(r["Timestamp"] is not None for r in rows)
    assert [f.dataType for f in bronze_rows(urls, bronze).schema] == [f.dataType for f in BRONZE]
