import zipfile

import pytest
from pyspark.sql import functions as F

from presswork.schemas import GOLD, SILVER
from presswork.sources import tables
from presswork.sources.feed import feed_urls, newest_feed_file, read_archives, read_feed
from presswork.sources.shared import materialize, shared_folder, spread

LINE = "id\t20240101\t1\t{name}\t{url}\trest\tmore"


@pytest.mark.parametrize(
    "manifest, expected",
    [
        ("1 aa http://f/1.export.CSV.zip\n2 bb http://f/1.gkg.csv.zip\n3 cc http://f/2.gkg.csv.zip\n", "http://f/1.gkg.csv.zip"),
        ("1 aa http://f/1.export.CSV.zip\n", None),
        ("1 http://f/1.gkg.csv.zip.md5\n2  http://f/9.gkg.csv.zip", "http://f/9.gkg.csv.zip"),
        ("", None),
    ],
)
def test_manifest_names_the_first_feed_file(spark, tmp_path, manifest, expected):
    (tmp_path / "last.txt").write_text(manifest)
    lines = spark.read.text(str(tmp_path / "last.txt"))
    assert [r["file_url"] for r in newest_feed_file(lines).collect()] == [expected]


def test_archives_give_lines_of_their_first_member(spark, tmp_path):
    for n in range(3):
        with zipfile.ZipFile(tmp_path / f"{n}.gkg.csv.zip", "w") as archive:
            lines = [LINE.format(name='"odd', url=f"http://{n}/{i}") for i in range(25_000)]
            archive.writestr("feed.csv", "\n".join(lines) + "\n\n")
            archive.writestr("second.csv", LINE.format(name="x", url="http://wrong"))
    (tmp_path / "notes.txt").write_text("not an archive")
    urls = feed_urls(read_archives(spark, str(tmp_path)))
    assert urls.count() == 75_000
    assert {r["url"] for r in urls.collect()} == {f"http://{n}/{i}" for n in range(3) for i in range(25_000)}


def test_archives_are_chosen_before_they_are_opened(spark, tmp_path):
    for n in range(3):
        with zipfile.ZipFile(tmp_path / f"{n}.gkg.csv.zip", "w") as archive:
            archive.writestr("feed.csv", LINE.format(name="x", url=f"http://{n}"))
    (tmp_path / "bad.gkg.csv.zip").write_bytes(b"no archive")
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    lines = read_archives(spark, str(tmp_path), "1.gkg.csv.zip")
    assert [r["url"] for r in feed_urls(lines).collect()] == ["http://1"]
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInPandas") < plan.index("Relation")
    assert len(lines.select("path").distinct().collect()) == 1
    assert read_archives(spark, str(tmp_path), "empty.zip").count() == 0


def test_feed_file_takes_column_by_position(spark, tmp_path):
    lines = [LINE.format(name='"stray', url="http://a"), "short\trow", "1\t2\t3\t4\t\t6", LINE.format(name="n", url="http://a")]
    (tmp_path / "feed.csv").write_text("\n".join(lines) + "\n")
    urls = [r["url"] for r in read_feed(spark, str(tmp_path / "feed.csv")).collect()]
    assert urls == ["http://a", None, None, "http://a"]
    same = [r["url"] for r in feed_urls(spark.read.text(str(tmp_path / "feed.csv"))).collect()]
    assert same == urls


def gold(spark, rows):
    return spark.createDataFrame(rows, GOLD)


def test_rerun_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.replace_partitions(gold(spark, [("a", "u", "x", "s", "e", 1), ("b", "u", "x", "s", "e", 2)]), path, ["batch"])
    for _ in range(2):
        tables.replace_partitions(gold(spark, [("c", "u", "x", "s", "e", 2)]), path, ["batch"])
    assert sorted(r["id"] for r in tables.read_layer(spark, path, "gold").collect()) == ["a", "c"]


def test_append_counts_rows(spark, tmp_path):
    path = str(tmp_path / "gold")
    rows = gold(spark, [("a", "u", "x", "s", "e", 1), ("b", "u", "x", "s", "e", 2)])
    assert tables.append_counted(rows, path, ["batch"]) == 2
    assert tables.append_counted(rows.where("false"), path, ["batch"]) == 0
    assert tables.read_layer(spark, path, "gold").count() == 2
    assert tables.write_report(spark, "updated", 0).first()["message"] == "No updates performed"
    assert tables.write_report(spark, "updated", 2).first()["message"] == "Successfully updated 2 records"


def test_compaction_keeps_rows_and_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "gold")
    rows = spark.range(200).select(
        F.col("id").cast("string").alias("id"), F.lit("u").alias("url"), F.lit("x").alias("article"),
        F.lit("s").alias("sentiment"), F.lit("e").alias("emotion"), (F.col("id") % 2).cast("int").alias("batch"),
    )
    rows.repartition(8).write.partitionBy("batch").parquet(path)
    before = len(list((tmp_path / "gold" / "batch=0").glob("*.parquet")))
    assert tables.compact_partition(spark, path, GOLD, "batch", 1, file_bytes=3_000) > 1
    assert tables.compact_partition(spark, path, GOLD, "batch", 1) == 1
    assert len(list((tmp_path / "gold" / "batch=1").glob("*.parquet"))) == 1
    assert len(list((tmp_path / "gold" / "batch=0").glob("*.parquet"))) == before > 1
    assert sorted(int(r["id"]) for r in tables.read_layer(spark, path, "gold").collect()) == list(range(200))


@pytest.mark.parametrize("layer, schema", [("silver", SILVER), ("gold", GOLD)])
def test_layer_tables(spark, tmp_path, layer, schema):
    name = f"t_{layer}"
    tables.create_layer_table(spark, name, layer)
    assert spark.table(name).schema == schema
    spark.createDataFrame([tuple(None for _ in schema)], schema).write.mode("append").insertInto(name)
    tables.create_layer_table(spark, name, layer, replace=True, location=str(tmp_path / layer))
    assert spark.table(name).count() == 0
    tables.drop_layer_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_bucketed_tables_join_without_shuffle(spark):
    for name in ("b_left", "b_right"):
        tables.create_layer_table(spark, name, "bronze", replace=True, buckets=4)
        rows = spark.range(100).selectExpr(
            "id as SNo", "id as batch", "current_timestamp() as Timestamp", "string(id) as url",
            "cast(0 as smallint) as processed", "cast(0 as smallint) as status",
        )
        assert tables.write_table(rows, name, "bronze") == 100
    joined = spark.table("b_left").hint("merge").join(spark.table("b_right").select("url"), "url")
    assert joined.count() == 100
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().toString()
    for name in ("b_left", "b_right"):
        tables.drop_layer_table(spark, name)


def test_writing_a_table_registers_its_partitions(spark, tmp_path):
    for location in (None, str(tmp_path / "gold_table")):
        tables.create_layer_table(spark, "t_gold", "gold", replace=True, location=location)
        rows = gold(spark, [("a", "u", "x", "s", "e", 1), ("b", "u", "x", "s", "e", 2)])
        assert tables.write_table(rows, "t_gold", "gold") == 2
        assert tables.write_table(rows.where("batch = 2"), "t_gold", "gold") == 1
        assert sorted(r["id"] for r in spark.table("t_gold").collect()) == ["a", "b"]
        if location:
            assert tables.read_layer(spark, location, "gold").count() == 2
        tables.drop_layer_table(spark, "t_gold")


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    kept = materialize(spark.range(10), "kept")
    assert kept.count() == 10
    assert all(shared_folder(spark) in name for name in kept.inputFiles())


def test_spread_only_touches_small_scans(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == cores
    wide = spark.range(10, numPartitions=cores + 1)
    assert spread(wide) is wide
