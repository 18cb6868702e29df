"""The queue's snapshot against joining the whole log, over runs, imports, replays and cut-short writes."""

import random
import re

import pytest
from pyspark.sql import functions as F

from presswork.operators import snapshot as snap
from presswork.operators.queue import work_queue
from presswork.plans.silver import current_queue, run_silver
from presswork.schemas import BRONZE, FETCH_LOG
from presswork.sources.shared import new_path
from presswork.sources.tables import read_layer, replace_partitions


def rows_of(df):
    return sorted(map(repr, df.select(BRONZE.names).drop("Timestamp").collect()))


@pytest.fixture
def tables(spark):
    """Paths of an empty queue, log and snapshot, and writers of a batch and of a run."""
    bronze, log, snapshot = (new_path(spark, n) for n in ("bronze", "log", "snapshot"))

    def batch(number, urls):
        rows = [(i, number, None, u, 0, 0) for i, u in enumerate(urls)]
        replace_partitions(spark.createDataFrame(rows, BRONZE), bronze, ["batch"])

    def run(number, outcomes):
        rows = [(u, p, s, number) for u, p, s in outcomes]
        replace_partitions(spark.createDataFrame(rows, FETCH_LOG), log, ["run_id"])

    return bronze, log, snapshot, batch, run


def check(spark, tables):
    bronze, log, snapshot, *_ = tables
    queue = read_layer(spark, bronze, "bronze")
    expected = current_queue(queue, spark.read.schema(FETCH_LOG).parquet(log))
    assert rows_of(snap.queue_from_snapshot(spark, snapshot, queue, log)) == rows_of(expected)


def test_snapshot_and_tail_give_the_whole_queue(spark, tables):
    bronze, log, snapshot, batch, run = tables
    rng = random.Random(4)
    urls = [f"u{i}" for i in range(40)]
    batch(1, [*urls[:25], "u1", None])
    run(5, [("u1", 1, 2), ("u2", 0, 1), ("u2", 1, 1), (None, 1, 2), ("stranger", 1, 2)])
    check(spark, tables)
    for step in range(3):
        queue = read_layer(spark, bronze, "bronze")
        snap.advance_snapshot(spark, snapshot, queue, log, buckets=8)
        check(spark, tables)
        assert snap.advance_snapshot(spark, snapshot, queue, log) == 0
        batch(2 + step, rng.sample(urls, 6))
        # A run with a lower number than one that was taken in does not replace it.
        run(4 - step, [("u1", 0, 1), ("u7", 1, 2)])
        run(10 + step, [(u, *rng.choice([(0, 1), (1, 2)])) for u in rng.sample(urls, 5)])
        check(spark, tables)


def test_only_touched_buckets_are_rewritten(spark, tables):
    from pathlib import Path

    bronze, log, snapshot, batch, run = tables
    batch(1, [f"u{i}" for i in range(200)])
    run(1, [("u3", 1, 2)])
    queue = read_layer(spark, bronze, "bronze")
    assert snap.advance_snapshot(spark, snapshot, queue, log, buckets=16) == 200
    before = {p: p.stat().st_mtime_ns for p in Path(snapshot).glob("bucket=*/*.parquet")}
    run(2, [("u9", 1, 2)])
    assert 0 < snap.advance_snapshot(spark, snapshot, queue, log) < 40
    after = {p: p.stat().st_mtime_ns for p in Path(snapshot).glob("bucket=*/*.parquet")}
    assert len({p.parent for p in before.keys() - after.keys()}) == 1 and len(before.keys() & after.keys()) >= 15
    check(spark, tables)


def test_advance_that_was_cut_short_is_done_again(spark, tables, monkeypatch):
    bronze, log, snapshot, batch, run = tables
    batch(1, ["a", "b"])
    run(1, [("a", 1, 2)])
    queue = read_layer(spark, bronze, "bronze")
    snap.advance_snapshot(spark, snapshot, queue, log, buckets=4)
    batch(2, ["a", "c"])
    run(2, [("a", 0, 1), ("c", 1, 2)])

    def stop(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(snap, "_store_state", stop)
    with pytest.raises(RuntimeError):
        snap.advance_snapshot(spark, snapshot, read_layer(spark, bronze, "bronze"), log)
    check(spark, tables)
    monkeypatch.undo()
    snap.advance_snapshot(spark, snapshot, read_layer(spark, bronze, "bronze"), log)
    check(spark, tables)
    assert spark.read.parquet(snapshot).count() == 4


def test_only_new_runs_of_the_log_are_read(spark, tables):
    bronze, log, snapshot, batch, run = tables
    batch(1, ["a"])
    for number in (1, 2, 3):
        run(number, [("a", 1, 2)])
    snap.advance_snapshot(spark, snapshot, read_layer(spark, bronze, "bronze"), log, buckets=4)
    run(4, [("a", 0, 1)])
    runs, outcomes = snap.new_outcomes(spark, log, snap.snapshot_state(spark, snapshot))
    assert runs == [4] and outcomes.count() == 1
    plan = outcomes._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\(run_id#\d+L = 4\)", plan)


def test_runs_on_a_snapshot_fetch_each_url_once(spark, tables):
    bronze, log, snapshot, batch, _ = tables
    crawl = spark.createDataFrame(
        [(i, f"u{i}", f"<title>t</title><article>x{i}</article>") for i in range(0, 30, 2)], "page_id bigint, url string, html string"
    )
    silver = new_path(spark, "silver")
    batch(1, [f"u{i}" for i in range(20)])
    run = lambda n: run_silver(read_layer(spark, bronze, "bronze"), crawl, silver, log, n, snapshot=snapshot)
    assert run(1) == {"silver": 10, "log": 20}
    batch(2, [f"u{i}" for i in range(15, 30)])
    assert run(2) == {"silver": 5, "log": 10} and run(2) == {"silver": 5, "log": 10}
    assert run(3) == {"silver": 0, "log": 0}
    queue = snap.queue_from_snapshot(spark, snapshot, read_layer(spark, bronze, "bronze"), log)
    assert work_queue(queue).count() == 0 and queue.count() == 35
    check(spark, tables)
    assert read_layer(spark, silver, "silver").select("url").distinct().count() == 15
    assert queue.where(F.col("status") == 2).count() == 15 + 2
