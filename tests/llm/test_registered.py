"""Registered queries of the operators: against their SQL, or for shape, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from check import differences
from llm.oracles import ORACLES
from llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


def test_all_are_registered():
    assert QUERIES.keys() <= registered.queries().keys() and "pipeline" in registered.queries()
    assert ORACLES.keys() <= registered.oracle_sql().keys() and ORACLES.keys() <= QUERIES.keys()
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, len(QUERIES) + 1))


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    assert differences(QUERIES[name](spark, SF), duck.sql(ORACLES[name])) == []


def test_every_document_is_answered(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op2_line_dedup", "op3_token_counts", "op8_sentencepiece", "op9_quality_classifier"):
        rows = QUERIES[name](spark, SF).select("doc_id").collect()
        assert len(rows) == len(set(rows)) == n
