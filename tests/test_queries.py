"""Every registered query against its SQL on the smallest tables, and the plans of all of them."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from check import differences

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")

PYTHON_QUERIES = {"labels_arrow", "gold_arrow", "subword_windows"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= registered.queries().keys()
    assert ORACLES.keys() <= registered.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql_and_plan_is_sound(spark, duck, name):
    result = QUERIES[name](spark, SF)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert ("Python" in plan or "MapInArrow" in plan) == (name in PYTHON_QUERIES)
    assert differences(result, duck.sql(ORACLES[name])) == []


def test_latest_batch_reads_one_partition(spark):
    plan = QUERIES["gold_latest"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan


def test_narrow_reads_stay_narrow(spark):
    plan = QUERIES["article_key"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def final_plan(result):
    """The plan that ran."""
    result.write.format("noop").mode("overwrite").save()
    frame = result.select("*")
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_large_model_is_joined_by_shuffle(spark):
    plan = final_plan(QUERIES["labels_salted"](spark, SF))
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan


def test_gold_needs_three_exchanges(spark):
    plan = QUERIES["keyed_predictions"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3
