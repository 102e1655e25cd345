"""Every registered query against its SQL."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, rows_of
from millrace.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, database, name):
    frame = QUERIES[name](spark, FOLDER)
    found = rows_of(frame.columns, frame.collect())
    assert found[1], "no rows"
    sql = ORACLES.get(name)
    if sql:
        relation = database.sql(sql)
        assert found == rows_of(relation.columns, relation.fetchall())


def test_only_these_queries_have_no_sql():
    # hashed embeddings; test_vectors checks them by other means
    assert set(QUERIES) - set(ORACLES) == {"text_embedding_default", "text_search_topk"}
    assert set(ORACLES) <= set(QUERIES)


def test_entry_module_has_them_all():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["ym", "area", "temp"]
    assert frame.count() > 0
