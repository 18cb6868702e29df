"""One function (spark, sf_dir) -> DataFrame per operator."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import tables as t
from presswork.functions.scores import label_of
from presswork.functions.subwords import subword_tokenizer
from presswork.functions.tokens import head_tokens, token_windows, tokens
from presswork.functions.urls import article_key, remove_urls
from presswork.operators import batches, fetch, queue
from presswork.operators.labels import (
    article_labels,
    label_articles,
    label_keys,
    window_label_index,
    window_labels,
    window_scores,
)
from presswork.operators.models import load_model
from presswork.operators.numbering import chunk_rows, dense_number
from presswork.operators.predict import linear_scorer, predict_labels, word_keys
from presswork.operators.snapshot import advance_snapshot, queue_from_snapshot
from presswork.plans.bronze import bronze_rows, run_import
from presswork.plans.gold import build_gold, build_latest_gold, gold_input, predict_gold
from presswork.plans.silver import build_silver, current_queue, run_silver_chunks
from presswork.schemas import SILVER
from presswork.sources.feed import read_feed
from presswork.sources.shared import new_path
from presswork.sources.tables import (
    append_counted,
    append_rows,
    compact_partition,
    read_layer,
    replace_partitions,
    write_report,
)
from presswork.streaming.evolving import epoch_counts
from presswork.streaming.gold import read_gold_stream, read_silver_stream, start_gold_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


SILVER_COLUMNS = ["SNo", "batch", "url", "article_title", "article_text", "transformed_text"]
QUEUE_COLUMNS = ["SNo", "batch", "url", "processed", "status"]


# --- queue -----------------------------------------------------------------------------------


@query("scan_bronze")
def scan_bronze(spark, sf):
    return t.bronze(spark, sf).select(QUEUE_COLUMNS)


@query("feed_scan")
def feed_scan(spark, sf):
    """Feed files written by Spark from all pages, read back by column position."""
    return read_feed(spark, _feed_files(spark, sf))


def _feed_files(spark, sf) -> str:
    landing = new_path(spark, "landing")
    fields = [F.col("page_id").cast("string"), F.lit("20240101"), F.lit("1"), F.lit('say "hi'), F.col("url"), F.lit("")]
    line = F.concat_ws("\t", *fields).alias("value")
    t.table(spark, sf, "pages").select(line).write.text(landing)
    return landing


@query("bronze_import")
def bronze_import(spark, sf):
    """Feed files -> numbered rows -> appended to a bronze table -> read back."""
    old = t.bronze(spark, sf)
    rows = bronze_rows(read_feed(spark, _feed_files(spark, sf)), old, t.loaded_at())
    path = new_path(spark, "bronze")
    append_rows(rows, path)
    return read_layer(spark, path, "bronze").select(QUEUE_COLUMNS)


@query("import_archives")
def import_archives(spark, sf):
    """Archives of all pages imported as a stream, then imported again, which adds nothing."""
    landing, path = t.archives(spark, sf), new_path(spark, "imported")
    for _ in range(2):
        run_import(spark, landing, path)
    return read_layer(spark, path, "bronze").select(QUEUE_COLUMNS)


@query("work_queue")
def work_queue(spark, sf):
    return queue.work_queue(t.bronze(spark, sf)).select(QUEUE_COLUMNS)


@query("queue_head")
def queue_head(spark, sf):
    return queue.queue_head(t.bronze(spark, sf), 500).select(QUEUE_COLUMNS)


@query("bronze_failed")
def bronze_failed(spark, sf):
    return queue.failed_rows(t.bronze(spark, sf)).select(QUEUE_COLUMNS)


@query("bronze_done")
def bronze_done(spark, sf):
    return queue.done_rows(t.bronze(spark, sf)).select(QUEUE_COLUMNS)


@query("status_breakdown")
def status_breakdown(spark, sf):
    return queue.status_breakdown(t.bronze(spark, sf))


@query("max_batch")
def max_batch(spark, sf):
    return batches.max_batch(t.bronze(spark, sf))


@query("next_batch")
def next_batch(spark, sf):
    return batches.next_batch(t.bronze(spark, sf))


@query("distinct_batches")
def distinct_batches(spark, sf):
    return batches.distinct_batches(t.silver(spark, sf))


@query("rows_per_batch")
def rows_per_batch(spark, sf):
    return batches.rows_per_batch(t.silver(spark, sf))


def _outcomes(spark, sf) -> DataFrame:
    """One outcome per row of the work queue: a repeated URL gives repeated outcomes."""
    todo = queue.work_queue(t.bronze(spark, sf)).select("url")
    return fetch.fetch_outcomes(fetch.locate_pages(todo, t.crawl(spark, sf)))


@query("fetch_outcome")
def fetch_outcome(spark, sf):
    """Outcome of every distinct URL of the whole queue."""
    urls = t.new_bronze(spark, sf).select("url").distinct()
    return fetch.fetch_outcomes(fetch.locate_pages(urls, t.crawl(spark, sf)))


@query("outcome_per_url")
def outcome_per_url(spark, sf):
    return queue.outcome_per_url(_outcomes(spark, sf))


@query("outcome_latest_run")
def outcome_latest_run(spark, sf):
    """Run 1 is what the queue shows, run 2 tried the open rows again; the later run wins."""
    first = t.bronze(spark, sf).select("url", "processed", "status", F.lit(1).cast("bigint").alias("run_id"))
    second = _outcomes(spark, sf).withColumn("run_id", F.lit(2).cast("bigint"))
    return queue.latest_outcome(first.unionByName(second))


@query("bronze_touched")
def bronze_touched(spark, sf):
    return queue.touched_rows(t.bronze(spark, sf), _outcomes(spark, sf)).select(QUEUE_COLUMNS)


@query("bronze_update")
def bronze_update(spark, sf):
    return queue.apply_outcomes(t.bronze(spark, sf), _outcomes(spark, sf)).select(QUEUE_COLUMNS)


@query("current_queue")
def current_queue_state(spark, sf):
    """The whole queue after a logged run over its open rows."""
    log = _outcomes(spark, sf).withColumn("run_id", F.lit(1_700_000_000_000_000_000).cast("bigint"))
    return current_queue(t.bronze(spark, sf), log).select(QUEUE_COLUMNS)


@query("queue_snapshot")
def queue_snapshot(spark, sf):
    """The same state from a snapshot that holds one run, and a second run that came after it."""
    path, log_path, bronze_path = (new_path(spark, n) for n in ("snapshot", "snapshot-log", "snapshot-queue"))
    replace_partitions(t.bronze(spark, sf), bronze_path, ["batch"])
    bronze = read_layer(spark, bronze_path, "bronze")
    outcomes = _outcomes(spark, sf)
    for run_id in (1, 2):
        mine = outcomes.where(F.crc32("url") % 2 == run_id - 1).withColumn("run_id", F.lit(run_id).cast("bigint"))
        replace_partitions(mine, log_path, ["run_id"])
        if run_id == 1:
            advance_snapshot(spark, path, bronze, log_path)
    return queue_from_snapshot(spark, path, bronze, log_path).select(QUEUE_COLUMNS)


@query("dense_sno")
def dense_sno(spark, sf):
    """All queue rows numbered 1..n by URL."""
    rows = t.bronze(spark, sf).select("url", F.col("SNo").alias("row_key"))
    return dense_number(rows, ["url", "row_key"])


@query("chunk_assign")
def chunk_assign(spark, sf):
    """All open queue rows in chunks of 500."""
    return chunk_rows(queue.work_queue(t.bronze(spark, sf)).select("SNo", "url"), ["SNo"])


# --- text ------------------------------------------------------------------------------------


@query("article_key")
def article_key_md5(spark, sf):
    return t.table(spark, sf, "pages").select("page_id", article_key(F.col("url")).alias("id"))


@query("page_extract")
def page_extract(spark, sf):
    return fetch.extract_articles(t.crawl(spark, sf))


@query("remove_urls")
def remove_urls_text(spark, sf):
    return t.documents_with_urls(spark, sf).select("doc_id", remove_urls(F.col("text")).alias("clean"))


@query("token_truncate")
def token_truncate(spark, sf):
    """What a scorer with a 512-word input sees of each document."""
    head = head_tokens(F.col("text"))
    return (
        t.documents(spark, sf)
        .select("doc_id", head.alias("head"))
        .select("doc_id", F.size("head").alias("n_tokens"), F.array_join("head", " ").alias("head"))
    )


def _long_articles(spark, sf) -> DataFrame:
    return t.documents(spark, sf).select("doc_id", F.col("text").alias("article"))


@query("token_windows")
def token_windows_all(spark, sf):
    """Every window of every document."""
    words = _long_articles(spark, sf).select("doc_id", tokens(F.col("article")).alias("words"))
    windows = words.select("doc_id", F.posexplode(token_windows(F.col("words"))).alias("window", "w"))
    return windows.select(
        "doc_id", "window", F.size("w").alias("n_tokens"), F.array_join("w", " ").alias("words")
    )


@query("subword_windows")
def subword_windows(spark, sf):
    """Windows of 512 subword tokens of every document: their number, and the digest of each."""
    tokenize = subword_tokenizer(t.subword_pieces(spark, sf))
    words = t.documents(spark, sf).select("doc_id", tokenize(F.col("text")).alias("words"))
    windows = words.select("doc_id", F.posexplode(token_windows(F.col("words"))).alias("window", "w"))
    digest = F.md5(F.array_join("w", " ")).alias("tokens_md5")
    return windows.select("doc_id", "window", F.size("w").alias("n_tokens"), digest)


@query("silver_nonempty")
def silver_nonempty(spark, sf):
    return fetch.non_empty(t.document_articles(spark, sf)).select("SNo", "batch", "url", "article_title")


@query("qa_title_without_text")
def qa_title_without_text(spark, sf):
    return fetch.title_without_text(t.document_articles(spark, sf)).select("SNo", "url", "article_title")


@query("silver_insert")
def silver_insert(spark, sf):
    """Non-empty, distinct articles of all documents."""
    rows = fetch.distinct_articles(fetch.non_empty(t.document_articles(spark, sf)))
    return rows.select(SILVER_COLUMNS)


# --- scoring ---------------------------------------------------------------------------------


def _scores(spark, sf, models) -> DataFrame:
    return window_scores(_long_articles(spark, sf), models, ["doc_id"], "article")


@query("window_scores")
def window_scores_sentiment(spark, sf):
    """Score of every class in every window of every document."""
    model = t.models(spark, sf)[0]
    scored = _scores(spark, sf, [model])
    return scored.select("doc_id", "window", F.posexplode("scores_sentiment").alias("label_idx", "score"))


@query("window_argmax")
def window_argmax(spark, sf):
    model = t.models(spark, sf)[1]
    scored = _scores(spark, sf, [model])
    return scored.select("doc_id", "window", window_label_index(model).alias("label_idx"))


@query("label_lookup")
def label_lookup(spark, sf):
    model = t.models(spark, sf)[1]
    index = window_label_index(model)
    scored = _scores(spark, sf, [model]).select("doc_id", "window", index.alias("label_idx"))
    return scored.withColumn("emotion", label_of(F.col("label_idx"), model.labels))


@query("window_vote")
def window_vote(spark, sf):
    """Majority of the window labels, with the number of windows."""
    model = t.models(spark, sf)[0]
    labels = window_labels(_scores(spark, sf, [model]), [model], ["doc_id"])
    return article_labels(labels, [model], ["doc_id"], F.count(F.lit(1)).alias("n_windows"))


@query("sentiment")
def sentiment(spark, sf):
    return label_keys(_long_articles(spark, sf), t.models(spark, sf)[:1], ["doc_id"])


@query("emotion")
def emotion(spark, sf):
    return label_keys(_long_articles(spark, sf), t.models(spark, sf)[1:], ["doc_id"])


@query("labels_head")
def labels_head(spark, sf):
    """Both labels of the first window of every document, all windows of which are scored."""
    models = t.models(spark, sf)
    labels = window_labels(_scores(spark, sf, models), models, ["doc_id"])
    return labels.where("window = 0").drop("window")


@query("labels_salted")
def labels_salted(spark, sf):
    """Both labels with the merge join, hot words dealt out, that serves models too large to broadcast."""
    return label_keys(_long_articles(spark, sf), t.models(spark, sf), ["doc_id"], broadcast_bytes=0)


@query("labels_arrow")
def labels_arrow(spark, sf):
    """Both labels from a pluggable scorer in Arrow batches."""
    models = t.models(spark, sf)
    articles, outputs = _long_articles(spark, sf), ["sentiment", "emotion"]
    scored = predict_labels(articles, linear_scorer(models), outputs, given=word_keys)
    return scored.select("doc_id", "sentiment", "emotion")


@query("keyed_predictions")
def keyed_predictions(spark, sf):
    """Every document with its own labels, joined back by key."""
    return label_articles(_long_articles(spark, sf), t.models(spark, sf), ["doc_id"])


@query("model_version_select")
def model_version_select(spark, sf):
    """Weights of the newest version and of an older, named version."""
    root = t.model_root(spark, sf)
    newest = load_model(spark, root, "sentiment")
    older = load_model(spark, root, "emotion", version=1)
    return newest.unionByName(older).select(
        "model", "version", "token", F.aggregate("w", F.lit(0), lambda a, b: a + b).alias("w_sum")
    )


# --- silver and gold -------------------------------------------------------------------------


@query("silver_build")
def silver_build(spark, sf):
    """Whole queue -> pages -> clean articles."""
    rows, _ = build_silver(t.new_bronze(spark, sf), t.crawl(spark, sf), loaded_at=t.loaded_at())
    return rows.select(SILVER_COLUMNS)


@query("silver_build_in_place")
def silver_build_in_place(spark, sf):
    """The same articles from pages in buckets by URL, which stay where they are."""
    crawl = t.stored_crawl(spark, sf)
    rows, _ = build_silver(t.new_bronze(spark, sf), crawl, loaded_at=t.loaded_at(), broadcast_bytes=0, in_place=True)
    return rows.select(SILVER_COLUMNS)


@query("silver_chunked")
def silver_chunked(spark, sf):
    """The same articles from a run in chunks of 500 with its state written between them, stopped and resumed."""
    silver_path, log_path = new_path(spark, "chunked-silver"), new_path(spark, "chunked-log")
    for most in (2, None):
        run_silver_chunks(t.new_bronze(spark, sf), t.crawl(spark, sf), silver_path, log_path, 1, most_commits=most)
    return read_layer(spark, silver_path, "silver").select(SILVER_COLUMNS)


@query("silver_build_shuffled")
def silver_build_shuffled(spark, sf):
    """The same by the shuffle that serves queues too long to broadcast."""
    rows, _ = build_silver(
        t.new_bronze(spark, sf), t.crawl(spark, sf), loaded_at=t.loaded_at(), broadcast_bytes=0
    )
    return rows.select(SILVER_COLUMNS)


@query("gold_input")
def gold_input_rows(spark, sf):
    return gold_input(t.silver(spark, sf))


@query("latest_batch_scalar")
def latest_batch_scalar(spark, sf):
    return batches.latest_batch(t.silver(spark, sf)).select(SILVER_COLUMNS)


@query("latest_batch_in_lookup")
def latest_batch_in_lookup(spark, sf):
    """The article with the highest URL, looked up in the latest batch of the queue."""
    rows = t.bronze(spark, sf)
    newest = batches.latest_batch(rows).agg(F.max("url")).scalar()
    return batches.latest_batch_lookup(rows, newest).select(QUEUE_COLUMNS)


@query("gold_all_batches")
def gold_all_batches(spark, sf):
    return build_gold(t.silver(spark, sf), t.models(spark, sf))


@query("gold_arrow")
def gold_arrow(spark, sf):
    """Gold of all batches from the pluggable scorer."""
    return predict_gold(t.silver(spark, sf), linear_scorer(t.models(spark, sf)), word_keys)


@query("gold_latest")
def gold_latest(spark, sf):
    return build_latest_gold(t.silver(spark, sf), t.models(spark, sf))


@query("gold_write_readback")
def gold_write_readback(spark, sf):
    """Gold as written, partitioned by batch."""
    return t.gold(spark, sf)


@query("gold_label_counts")
def gold_label_counts(spark, sf):
    """Articles per batch, sentiment and emotion."""
    labelled = build_gold(t.silver(spark, sf), t.models(spark, sf))
    return labelled.groupBy("batch", "sentiment", "emotion").agg(F.count(F.lit(1)).alias("n_articles"))


@query("write_metrics")
def write_metrics(spark, sf):
    """Report of appending all silver rows."""
    path = new_path(spark, "counted")
    return write_report(spark, "inserted", append_counted(t.silver(spark, sf), path, ["batch"]))


@query("compact_partition")
def compact_partition_rows(spark, sf):
    """Silver in many small files, its latest batch then rewritten into few."""
    path = new_path(spark, "compact")
    rows = t.silver(spark, sf)
    rows.repartition(16).write.partitionBy("batch").parquet(path)
    newest = batches.max_batch(rows).first()["max_batch"]
    compact_partition(spark, path, SILVER, "batch", newest)
    return spark.read.schema(SILVER).parquet(path).select(SILVER_COLUMNS)


def _run_stream(spark, sf) -> str:
    path, checkpoint = new_path(spark, "stream-gold"), new_path(spark, "stream-state")
    stream = read_silver_stream(spark, t.silver_path(spark, sf), files_per_trigger=1000)
    start_gold_stream(stream, path, checkpoint, t.models(spark, sf)).awaitTermination()
    return path


@query("stream_gold")
def stream_gold(spark, sf):
    """All silver files as a stream, labelled per micro-batch, read back."""
    return read_gold_stream(spark, _run_stream(spark, sf))


@query("stream_counts")
def stream_counts(spark, sf):
    """What a stream over all silver files read and wrote, from its counts by epoch."""
    sums = [F.sum(c).alias(c) for c in ("rows_read", "articles", "rows_written")]
    return epoch_counts(spark, _run_stream(spark, sf)).agg(*sums)
