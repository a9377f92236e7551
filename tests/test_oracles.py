"""Every query against its SQL, run by DuckDB on the same files."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from helpers import assert_equals_sql, connect

FOLDERS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]
QUERIES = entry._own_queries()
CHECKS = entry.sql_checks.all_checks()


@pytest.fixture(scope="module", params=FOLDERS, ids=lambda f: Path(f).name)
def tables(request):
    return request.param, connect(request.param)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, tables, name):
    folder, con = tables
    assert assert_equals_sql(QUERIES[name](spark, folder), con, CHECKS[name]) > 0


def test_only_random_queries_lack_sql():
    assert set(QUERIES) - set(CHECKS) == {"invoice_preview"}


def test_preview_is_a_few_whole_rows(spark):
    df = QUERIES["invoice_preview"](spark, FOLDERS[0])
    assert len(df.columns) == 4 and df.count() == 10


def test_entry(spark):
    assert entry.entry(spark).count() > 0
