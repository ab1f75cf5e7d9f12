"""Registered queries against their checking statements, at the smallest scale.

``check_oracle.py`` does the same for all of them at any scale; here are those
whose operators no other test runs over the given tables.
"""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
CHOSEN = [
    "q01", "q02", "q04", "q06", "q07_match_or_create", "q08", "q10", "q13", "q15", "q16", "q18",
    "q19", "q22", "q24", "q30_invoice_items", "q32_opportunities", "q36", "q37_custom_fields", "q41",
]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_transfer_query_is_checked():
    assert QUERIES.keys() <= queries().keys()
    assert QUERIES.keys() <= oracle_sql().keys() <= queries().keys()


def test_entry(spark):
    assert entry(spark).columns == ["old_id", "new_id"]


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(tuple(CHOSEN))])
def test_same_result(spark, con, name):
    good, note = compare(spark, con, name, queries()[name], oracle_sql()[name], FOLDER)
    assert good, note
