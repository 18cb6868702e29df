import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.functions.constants import EMOTIONS, SENTIMENTS
from presswork.operators.batches import rows_per_batch
from presswork.operators.models import emotion_model, rule_weights, save_model, sentiment_model
from presswork.operators.queue import apply_outcomes, latest_outcome, work_queue
from presswork.plans.gold import build_gold, build_latest_gold, write_gold
from presswork.plans.bronze import run_import
from presswork.plans.silver import build_silver, current_queue, run_silver, run_silver_chunks
from presswork.schemas import BRONZE, FETCH_LOG, GOLD, SILVER
from presswork.sources.shared import Work, new_path, path_exists, paths_like, shared_folder
from presswork.sources.tables import compact_partition, create_layer_table, drop_layer_table, read_layer, replace_partitions, store_crawl, write_table
from presswork.streaming import evolving
from presswork.streaming.evolving import epoch_counts
from presswork.streaming.gold import (
    gold_sink,
    read_all_gold,
    read_gold_stream,
    read_silver_stream,
    start_gold_stream,
    written_elsewhere,
)

N = 60


@pytest.fixture(scope="module")
def models(spark):
    root = new_path(spark, "models")
    words = spark.range(N).select(F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij").alias("token"))
    for name, labels in (("sentiment", SENTIMENTS), ("emotion", EMOTIONS)):
        save_model(rule_weights(words, name, 1, len(labels)), root, name, 1)
    return [sentiment_model(spark, root), emotion_model(spark, root)]


@pytest.fixture(scope="module")
def bronze(spark):
    """N URLs, each twice, a third of them not in the crawl."""
    return spark.range(2 * N).selectExpr(
        "id + 1 as SNo", "1L as batch", "current_timestamp() as Timestamp", f"concat('u', id % {N}) as url",
        "cast(0 as smallint) as processed", "cast(0 as smallint) as status",
    )


@pytest.fixture(scope="module")
def crawl(spark):
    word = "translate(string(id), '0123456789', 'abcdefghij')"
    return spark.range(N).where("id % 3 != 0").selectExpr(
        "id as page_id", "concat('u', id) as url",
        f"concat('<title>t', id, '</title><article>', {word}, ' ', {word}, '</article>') as html",
    )


def plain(df, columns):
    return sorted(map(repr, df.select(columns).collect()))


CONTENT = ["SNo", "batch", "url", "article_title", "article_text", "transformed_text"]


def test_silver_fetches_each_url_once(spark, bronze, crawl):
    silver, outcomes = build_silver(bronze, crawl, chunk_size=25)
    assert silver.select("SNo").distinct().count() == silver.count() == N * 2 // 3
    assert silver.select("url").distinct().count() == N * 2 // 3
    assert outcomes.count() == N
    by_number = {r["url"]: (r["SNo"], r["batch"]) for r in silver.collect()}
    assert by_number["u1"] == (2, 1) and by_number["u26"] == (27, 2) and by_number["u59"] == (60, 3)
    assert [f.name for f in silver.schema] == [f.name for f in SILVER]
    assert [f.dataType for f in silver.schema] == [f.dataType for f in SILVER]


def test_small_and_large_queues_give_the_same_silver(spark, bronze, crawl):
    small, _ = build_silver(bronze, crawl, chunk_size=25)
    large, _ = build_silver(bronze, crawl, chunk_size=25, broadcast_bytes=0)
    assert plain(small, CONTENT) == plain(large, CONTENT)


def _moved_columns(spark, df):
    """The columns of every exchange in a plan."""
    explain = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", explain(df._jdf.queryExecution(), "formatted"))


def test_pages_in_buckets_stay_where_they_are(spark, bronze, crawl):
    # Two pages of one URL: the newer one counts.
    older = crawl.where("page_id = 4").selectExpr("-1L as page_id", "url", "'<title>old</title><article>old</article>' as html")
    pages = crawl.unionByName(older)
    stored = store_crawl(pages, "t_crawl", 6)
    moved, _ = build_silver(bronze, pages, chunk_size=25, broadcast_bytes=0)
    still, outcomes = build_silver(bronze, stored, chunk_size=25, broadcast_bytes=0, in_place=True)
    assert any("html" in columns for columns in _moved_columns(spark, moved))
    exchanges = _moved_columns(spark, still)
    assert exchanges and not any("html" in columns or "article" in columns for columns in exchanges)
    assert plain(still, CONTENT) == plain(moved, CONTENT)
    assert outcomes.count() == N
    store_crawl(pages.selectExpr("page_id + 1000 as page_id", "url", "html"), "t_crawl", 6, append=True)
    again, _ = build_silver(bronze, spark.table("t_crawl"), chunk_size=25, broadcast_bytes=0, in_place=True)
    assert again.count() == N * 2 // 3
    drop_layer_table(spark, "t_crawl")


def test_later_runs_number_on(spark, bronze, crawl):
    first, _ = build_silver(bronze, crawl, chunk_size=25)
    second, _ = build_silver(bronze, crawl, silver=first, chunk_size=25)
    assert {r["batch"] for r in second.collect()} == {4, 5, 6}


def test_rerun_changes_nothing_and_empties_the_queue(spark, bronze, crawl):
    silver_path, log_path = new_path(spark, "silver"), new_path(spark, "log")
    run_silver(bronze, crawl, silver_path, log_path, run_id=1, chunk_size=25)
    once = plain(read_layer(spark, silver_path, "silver"), CONTENT)
    live = read_layer(spark, silver_path, "silver")
    counts = run_silver(bronze, crawl, silver_path, log_path, run_id=1, silver=live, chunk_size=25)
    assert counts == {"silver": N * 2 // 3, "log": N}
    assert plain(read_layer(spark, silver_path, "silver"), CONTENT) == once
    log = spark.read.schema(FETCH_LOG).parquet(log_path)
    assert log.count() == N
    after = apply_outcomes(bronze, latest_outcome(log))
    assert after.count() == bronze.count() and work_queue(after).count() == 0
    states = {(r["processed"], r["status"]): r["count"] for r in after.groupBy("processed", "status").count().collect()}
    assert states == {(0, 1): 2 * N // 3, (1, 2): 4 * N // 3}


def test_second_run_fetches_only_what_is_new(spark, bronze, crawl, tmp_path):
    silver_path, log_path = new_path(spark, "silver"), new_path(spark, "log")
    run_silver(bronze.where("url < 'u3'"), crawl, silver_path, log_path, run_id=5)
    tried = {r["url"] for r in spark.read.schema(FETCH_LOG).parquet(log_path).collect()}
    later = 1_700_000_000_000_000_000
    counts = run_silver(bronze, crawl, silver_path, log_path, run_id=later)
    log = spark.read.schema(FETCH_LOG).parquet(log_path)
    assert counts["log"] == N - len(tried) and log.count() == N
    assert {r["url"] for r in log.where(F.col("run_id") == later).collect()}.isdisjoint(tried)
    silver = read_layer(spark, silver_path, "silver")
    assert silver.count() == silver.select("url").distinct().count() == N * 2 // 3
    assert {r["batch"] for r in silver.collect()} == {1, 2}
    assert work_queue(current_queue(bronze, log)).count() == 0


def test_chunked_run_stops_and_resumes(spark, bronze, crawl):
    silver_path, log_path = new_path(spark, "silver"), new_path(spark, "log")
    read_log = lambda: spark.read.schema(FETCH_LOG).parquet(log_path)
    run = lambda most=None: run_silver_chunks(bronze, crawl, silver_path, log_path, 7, chunk_size=12, most_commits=most)
    first = run(2)
    assert (first.commits, first.done, first.planned, first.log) == (2, 2, 5, 24)
    assert read_log().count() == 24 and work_queue(current_queue(bronze, read_log())).count() == 2 * (N - 24)
    # The third chunk is cut short after its articles: it has no commit and is written again.
    whole, _ = build_silver(bronze, crawl, chunk_size=12)
    replace_partitions(whole.where("batch = 3").limit(2), silver_path, ["batch"])
    rest = run()
    assert (rest.commits, rest.done, rest.planned, rest.log) == (3, 5, 5, N - 24)
    assert run().commits == 0
    assert read_log().count() == N == read_log().select("url").distinct().count()
    assert {r["run_id"] for r in read_log().collect()} == {7}
    assert plain(read_layer(spark, silver_path, "silver"), CONTENT) == plain(whole, CONTENT)
    # A later run of the plain kind sees these outcomes, and stands in the same log.
    assert run_silver(bronze, crawl, silver_path, log_path, run_id=8)["log"] == 0
    more = bronze.where("SNo = 1").withColumn("url", F.lit("new"))
    assert run_silver(bronze.unionByName(more), crawl, silver_path, log_path, run_id=9)["log"] == 1
    assert read_log().count() == N + 1


def test_chunked_run_meets_the_crawl_once(spark, bronze, crawl, monkeypatch):
    from presswork.plans import silver

    calls = []
    locate = silver.locate_pages
    monkeypatch.setattr(silver, "locate_pages", lambda *a, **b: calls.append(a) or locate(*a, **b))
    found = run_silver_chunks(bronze, crawl, new_path(spark, "silver"), new_path(spark, "log"), 1, chunk_size=25)
    assert found.commits == found.planned > 1 and len(calls) == 1


def _jobs(spark, group, run):
    """What a call returns, and the number of Spark jobs that it started."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(key, None)


def test_chunked_run_needs_no_jobs_for_a_commit(spark, bronze, crawl):
    def run(size):
        paths = new_path(spark, "silver"), new_path(spark, "log")
        found, jobs = _jobs(spark, f"commits-{size}", lambda: run_silver_chunks(bronze, crawl, *paths, 1, chunk_size=size))
        return found, jobs, *paths

    few, few_jobs, *_ = run(20)
    many, many_jobs, silver_path, log_path = run(2)
    assert (few.commits, many.commits) == (3, 30) and few.silver == many.silver == N * 2 // 3
    # A commit that ran one would add 27.
    assert 0 < many_jobs < few_jobs + 20
    whole, _ = build_silver(bronze, crawl, chunk_size=2)
    assert plain(read_layer(spark, silver_path, "silver"), CONTENT) == plain(whole, CONTENT)
    assert len(paths_like(spark, f"{log_path}/run_id=1/chunks-*/_SUCCESS")) == 30


@pytest.mark.parametrize("chunks_per_commit, ahead", [(1, 24), (2, 1), (3, 100_000)])
def test_chunked_run_in_stretches(spark, bronze, crawl, monkeypatch, chunks_per_commit, ahead):
    """Articles of some commits are made ahead; a failure leaves what was committed, and no trace of the others."""
    from presswork.plans import silver

    monkeypatch.setattr(silver, "AHEAD_URLS", ahead)
    silver_path, log_path = new_path(spark, "silver"), new_path(spark, "log")
    read_log = lambda: spark.read.schema(FETCH_LOG).parquet(log_path)
    # Pages meet the queue in a merge join.
    run = lambda: run_silver_chunks(bronze, crawl, silver_path, log_path, 3, chunk_size=12, chunks_per_commit=chunks_per_commit, broadcast_bytes=0)
    whole, outcomes = build_silver(bronze, crawl, chunk_size=12)
    move, moved = silver.Mover.move, []

    def seen(self, source, target):
        moved.append(target)
        if target.endswith(f"chunks-{1 + chunks_per_commit}"):
            raise OSError("no space")
        move(self, source, target)

    monkeypatch.setattr(silver.Mover, "move", seen)
    with pytest.raises(OSError):
        run()
    # The second commit has its articles in place and is not there yet; the third was not begun.
    assert [p.split("/")[-1] for p in moved] == [
        *(f"batch={b}" for b in range(1, chunks_per_commit + 1)), "chunks-1",
        *(f"batch={b}" for b in range(chunks_per_commit + 1, min(2 * chunks_per_commit, 5) + 1)), f"chunks-{1 + chunks_per_commit}",
    ]
    assert read_log().count() == 12 * chunks_per_commit == read_log().where("run_id = 3").count()
    assert {r["batch"] for r in read_layer(spark, silver_path, "silver").collect()} == set(range(1, min(2 * chunks_per_commit, 5) + 1))
    assert not paths_like(spark, f"{silver_path}/_ready*") and not paths_like(spark, f"{log_path}/_ready*")
    monkeypatch.setattr(silver.Mover, "move", move)
    rest = run()
    assert (rest.commits, rest.done, rest.log) == (rest.planned - 1, rest.planned, N - 12 * chunks_per_commit)
    assert rest.silver == whole.where(F.col("batch") > chunks_per_commit).count()
    assert plain(read_layer(spark, silver_path, "silver"), CONTENT) == plain(whole, CONTENT)
    flags = ["url", "processed", "status"]
    assert plain(read_log(), flags) == plain(outcomes, flags)


def test_chunked_run_without_any_page(spark, bronze, crawl):
    """No batch has an article: every commit is made, silver is there and empty."""
    silver_path, log_path = new_path(spark, "silver"), new_path(spark, "log")
    found = run_silver_chunks(bronze, crawl.where("false"), silver_path, log_path, 1, chunk_size=25)
    assert (found.commits, found.planned, found.silver, found.log) == (3, 3, 0, N)
    assert read_layer(spark, silver_path, "silver").count() == 0
    assert spark.read.schema(FETCH_LOG).parquet(log_path).where("status = 1").count() == N


def test_chunked_run_keeps_its_rate(spark, bronze, crawl):
    import time

    start = time.monotonic()
    found = run_silver_chunks(
        bronze, crawl, new_path(spark, "silver"), new_path(spark, "log"), 1, chunk_size=15, chunks_per_commit=2, urls_per_second=6
    )
    assert (found.commits, found.planned) == (2, 2) and time.monotonic() - start >= 30 / 6
    empty = run_silver_chunks(bronze.where("false"), crawl, new_path(spark, "silver"), new_path(spark, "log"), 1)
    assert (empty.commits, empty.planned) == (0, 0)


def test_rows_without_url_are_left_alone(spark, bronze, crawl):
    nameless = bronze.limit(1).withColumn("url", F.lit(None).cast("string"))
    silver, outcomes = build_silver(bronze.unionByName(nameless), crawl)
    assert silver.count() == N * 2 // 3 and outcomes.count() == N


def _land(folder, **archives):
    import zipfile

    folder.mkdir(exist_ok=True)
    for name, urls in archives.items():
        with zipfile.ZipFile(folder / f"{name}.gkg.csv.zip", "w") as archive:
            archive.writestr("feed.csv", "".join(f'1\t2\t3\t"4\t{u}\t6\n' for u in urls))


def _queue(spark, path):
    return sorted((r["batch"], r["SNo"], r["url"]) for r in read_layer(spark, path, "bronze").collect())


def test_import_takes_each_archive_once(spark, tmp_path):
    landing, path = tmp_path / "landing", new_path(spark, "bronze")
    _land(landing, a=["u1", "u2"], b=["u3"])
    assert run_import(spark, str(landing), path) == 3
    first = [(1, 1, "u1"), (1, 2, "u2"), (1, 3, "u3")]
    assert run_import(spark, str(landing), path) == 0 and _queue(spark, path) == first
    _land(landing, c=["u3", "u4"])
    assert run_import(spark, str(landing), path) == 2 and run_import(spark, str(landing), path) == 0
    assert _queue(spark, path) == [*first, (2, 1, "u3"), (2, 2, "u4")]
    rows = read_layer(spark, path, "bronze")
    assert {(r["processed"], r["status"]) for r in rows.collect()} == {(0, 0)}
    assert rows.columns == BRONZE.names


def test_manifest_opens_only_what_it_names(spark, tmp_path):
    landing, path, manifest = tmp_path / "landing", new_path(spark, "bronze"), tmp_path / "list.txt"
    _land(landing, **{"a": ["u1"], "b[1]*": ["u2"], "b1": ["u9"]})
    (landing / "broken.gkg.csv.zip").write_bytes(b"no archive")
    manifest.write_text("1 x http://h/other.zip\n2 y http://h/b[1]*.gkg.csv.zip\n")
    assert run_import(spark, str(landing), path, str(manifest)) == 1 and _queue(spark, path) == [(1, 1, "u2")]
    assert run_import(spark, str(landing), path, str(manifest)) == 0
    manifest.write_text("1 y http://h/none.zip\n")
    assert run_import(spark, str(landing), path, str(manifest)) == 0
    manifest.write_text("1 y http://h/a.gkg.csv.zip\n")
    assert run_import(spark, str(landing), path, str(manifest)) == 1
    assert _queue(spark, path) == [(1, 1, "u2"), (2, 1, "u1")]


def test_replayed_import_writes_the_same_batch(spark, tmp_path):
    landing, path = tmp_path / "landing", new_path(spark, "bronze")
    _land(landing, a=["u1", "u2"])
    assert run_import(spark, str(landing), path) == 2
    # A checkpoint that lost its last commit has the stream give the epoch again.
    checkpoint = Path(path) / "_import" / "checkpoint" / "commits"
    for file in checkpoint.glob("*0*"):
        file.unlink()
    assert run_import(spark, str(landing), path) == 2
    assert _queue(spark, path) == [(1, 1, "u1"), (1, 2, "u2")]


def test_old_archives_are_not_passed_over(spark, tmp_path):
    import os

    landing, path = tmp_path / "landing", new_path(spark, "bronze")
    _land(landing, a=["u1"])
    assert run_import(spark, str(landing), path) == 1
    _land(landing, b=["u2"])
    os.utime(landing / "b.gkg.csv.zip", (1_000_000_000, 1_000_000_000))
    assert run_import(spark, str(landing), path) == 1


def test_queue_without_batch_folders_is_not_mixed(spark, tmp_path):
    path = new_path(spark, "bronze")
    spark.createDataFrame([], BRONZE).write.parquet(path)
    with pytest.raises(ValueError, match="batch folders"):
        run_import(spark, str(tmp_path), path)


def test_work_folder_goes_with_its_flow(spark, bronze, crawl):
    from pathlib import Path

    folder = Path(shared_folder(spark)) / "presswork"
    before = {p.name for p in folder.iterdir()} if folder.exists() else set()
    silver_path, log_path = new_path(spark, "kept-silver"), new_path(spark, "kept-log")
    run_silver(bronze, crawl, silver_path, log_path, run_id=1)
    left = {p.name for p in folder.iterdir()} - before
    assert {name.rsplit("-", 1)[0] for name in left} == {"kept-silver", "kept-log"}
    with Work(spark) as work:
        stored = work.materialize(spark.range(3), "x")
        assert stored.count() == 3 and path_exists(spark, work.path)
    assert not path_exists(spark, work.path)


@pytest.fixture(scope="module")
def silver_path(spark, bronze, crawl):
    path = new_path(spark, "silver")
    rows, _ = build_silver(bronze, crawl, chunk_size=25)
    replace_partitions(rows, path, ["batch"])
    return path


def test_gold_has_every_article_once(spark, silver_path, models):
    silver = read_layer(spark, silver_path, "silver")
    gold = build_gold(silver, models)
    assert gold.schema.names == GOLD.names
    assert [f.dataType for f in gold.schema] == [f.dataType for f in GOLD]
    assert gold.count() == silver.count() == gold.select("id").distinct().count()
    assert sorted(map(tuple, rows_per_batch(gold).collect())) == sorted(map(tuple, rows_per_batch(silver).collect()))
    latest = build_latest_gold(silver, models)
    assert {r["batch"] for r in latest.collect()} == {3}
    assert plain(latest, GOLD.names) == plain(gold.where("batch = 3"), GOLD.names)


def test_gold_write_is_replay_safe(spark, silver_path, models):
    silver = read_layer(spark, silver_path, "silver")
    path = new_path(spark, "gold")
    write_gold(build_gold(silver, models), path)
    write_gold(build_latest_gold(silver, models), path)
    assert plain(read_layer(spark, path, "gold"), GOLD.names) == plain(build_gold(silver, models), GOLD.names)


def test_stream_equals_batch_and_takes_new_files_once(spark, bronze, crawl, models):
    rows, _ = build_silver(bronze, crawl, chunk_size=25)
    source, path, state = (new_path(spark, name) for name in ("in", "out", "state"))
    rows.where("batch < 3").repartition(4).write.partitionBy("batch").parquet(source)
    expected = build_gold(rows, models)

    def run():
        stream = read_silver_stream(spark, source, files_per_trigger=2)
        query = start_gold_stream(stream, path, state, models)
        assert query.awaitTermination(300)
        return read_gold_stream(spark, path)

    assert plain(run(), GOLD.names) == plain(expected.where("batch < 3"), GOLD.names)
    assert run().count() == expected.where("batch < 3").count()
    rows.where("batch = 3").write.mode("append").partitionBy("batch").parquet(source)
    assert plain(run(), GOLD.names) == plain(expected, GOLD.names)


def test_replayed_epoch_is_not_doubled(spark, silver_path, models):
    path = new_path(spark, "out")
    silver = read_layer(spark, silver_path, "silver")
    write = gold_sink(path, models)
    write(silver.where("SNo <= 30"), 0)
    write(silver.where("SNo > 30"), 1)
    write(silver.where("SNo > 30"), 1)
    assert plain(read_gold_stream(spark, path), GOLD.names) == plain(build_gold(silver, models), GOLD.names)


def test_stream_of_one_batch(spark, silver_path, models):
    path, state = new_path(spark, "out"), new_path(spark, "state")
    start_gold_stream(read_silver_stream(spark, silver_path, batch=2), path, state, models).awaitTermination(300)
    assert {r["batch"] for r in read_gold_stream(spark, path).collect()} == {2}


def test_rewritten_silver_adds_nothing_to_the_stream(spark, bronze, crawl, models):
    rows, _ = build_silver(bronze, crawl, chunk_size=25)
    source, path, state = (new_path(spark, name) for name in ("in", "out", "state"))
    rows.repartition(3).write.partitionBy("batch").parquet(source)

    def run(checkpoint):
        query = start_gold_stream(read_silver_stream(spark, source), path, checkpoint, models)
        assert query.awaitTermination(300)
        return plain(read_gold_stream(spark, path), GOLD.names)

    once = run(state)
    assert len(once) == N * 2 // 3
    compact_partition(spark, source, SILVER, "batch", 1)
    assert run(state) == once
    stored = read_layer(spark, source, "silver").where("batch = 2")
    stored = spark.createDataFrame(stored.collect(), stored.schema)
    replace_partitions(stored, source, ["batch"])
    assert run(state) == once
    assert run(new_path(spark, "state")) == once


def test_stream_from_a_table_runs_on(spark, silver_path, models):
    create_layer_table(spark, "t_silver", "silver", replace=True)
    write_table(read_layer(spark, silver_path, "silver"), "t_silver", "silver")
    path, state = new_path(spark, "out"), new_path(spark, "state")
    stream = read_silver_stream(spark, table="t_silver")
    query = start_gold_stream(stream, path, state, models, trigger={"processingTime": "1 second"})
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert read_gold_stream(spark, path).count() == spark.table("t_silver").count()
    drop_layer_table(spark, "t_silver")


def _one_per_epoch(spark, silver_path):
    """Silver rows one by one, as a stream would bring them."""
    silver = read_layer(spark, silver_path, "silver").where("batch = 1").orderBy("SNo").collect()
    return [spark.createDataFrame([r], SILVER) for r in silver]


def test_only_the_batches_of_a_micro_batch_are_read(spark, silver_path, models):
    path = new_path(spark, "out")
    write = gold_sink(path, models)
    silver = read_layer(spark, silver_path, "silver")
    write(silver.where("batch <= 2"), 0)
    keys = silver.where("batch = 2").select("batch", F.md5("url").alias("_id"))
    found = written_elsewhere(keys, path, "gold", 1, [2], few=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert re.search(r"\(batch#\d+ =", filters)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert found.count() == keys.count()
    assert written_elsewhere(keys, path, "gold", 1, None, few=False).count() == keys.count()
    assert written_elsewhere(keys, path, "gold", 0, [2], few=True).count() == 0


def test_folders_stay_few_over_many_epochs(spark, silver_path, models, monkeypatch):
    monkeypatch.setattr(evolving, "MERGE_EPOCHS", 3)
    path = new_path(spark, "out")
    write = gold_sink(path, models)
    pieces = _one_per_epoch(spark, silver_path)[:7]
    for epoch, piece in enumerate(pieces):
        write(piece, epoch)
        write(piece, epoch)
    folders = list(Path(path).glob("batch=1/stream=gold/epoch_id=*"))
    assert len(folders) <= 4 and any("=-" in f.name for f in folders)
    rows = read_gold_stream(spark, path)
    assert rows.count() == rows.select("id").distinct().count() == 7
    counts = epoch_counts(spark, path)
    assert counts.count() == 7 and counts.agg(F.sum("rows_written")).first()[0] == 7


def test_merge_that_was_cut_short_shows_no_row_twice(spark, silver_path, models, monkeypatch):
    monkeypatch.setattr(evolving, "MERGE_EPOCHS", 2)
    path = new_path(spark, "out")
    write = gold_sink(path, models)
    pieces = _one_per_epoch(spark, silver_path)[:5]
    for epoch in range(2):
        write(pieces[epoch], epoch)
    monkeypatch.setattr(evolving, "delete_path", lambda spark, path: None)
    write(pieces[2], 2)
    assert len(list(Path(path).glob("batch=1/stream=gold/epoch_id=*"))) == 4
    assert read_gold_stream(spark, path).count() == 3
    monkeypatch.undo()
    write(pieces[3], 3)
    assert sorted(p.name for p in Path(path).glob("batch=1/stream=gold/epoch_id=*")) == ["epoch_id=-2", "epoch_id=2", "epoch_id=3"]
    assert read_gold_stream(spark, path).count() == 4


def test_stream_may_gain_a_column(spark, bronze, crawl, models):
    rows, _ = build_silver(bronze, crawl, chunk_size=25)
    source, path, state, batch_path = (new_path(spark, n) for n in ("in", "out", "state", "gold"))
    rows.where("batch = 1").write.partitionBy("batch").parquet(source)
    run = lambda more: start_gold_stream(read_silver_stream(spark, source, more=more), path, state, models).awaitTermination(300)
    assert run(None)
    rows.where("batch = 2").withColumn("author", F.concat(F.lit("by "), "url")).write.mode("append").partitionBy("batch").parquet(source)
    assert run(T.StructType([T.StructField("author", T.StringType())]))
    found = read_gold_stream(spark, path)
    assert found.columns == [*GOLD.names, "author"]
    assert plain(found, GOLD.names) == plain(build_gold(rows.where("batch < 3"), models), GOLD.names)
    assert {(r["batch"], r["author"] == f"by {r['url']}") for r in found.collect()} == {(1, False), (2, True)}
    assert found.where("batch = 1 and author is not null").count() == 0
    write_gold(build_gold(rows.where("batch = 3"), models), batch_path)
    assert read_all_gold(spark, batch_path, path).count() == rows.count()
    wrong = rows.where("batch = 3").withColumn("author", F.lit(1))
    with pytest.raises(ValueError, match="author is string, not int"):
        gold_sink(path, models)(wrong, 9)


def test_counts_of_epochs_add_up_after_a_replay(spark, silver_path, models):
    path = new_path(spark, "out")
    silver = read_layer(spark, silver_path, "silver")
    write = gold_sink(path, models)
    write(silver.where("SNo <= 30").unionByName(silver.where("SNo <= 5")), 0)
    for _ in range(2):
        write(silver.where("SNo > 20"), 1)
    write(silver.where("false"), 2)
    n = {(r["epoch_id"], r["rows_read"], r["articles"], r["rows_written"]) for r in epoch_counts(spark, path).collect()}
    at = lambda condition: silver.where(condition).count()
    first, both = at("SNo <= 30"), at("SNo > 20 and SNo <= 30")
    assert n == {(0, first + at("SNo <= 5"), first, first), (1, at("SNo > 20"), at("SNo > 20"), at("SNo > 20") - both), (2, 0, 0, 0)}
    assert sum(x[3] for x in n) == read_gold_stream(spark, path).count() == silver.count()
