"""Every corpus query with SQL against it, run by DuckDB on the same files."""

import pytest

from anticipa.llm import queries as corpus
from helpers import assert_equals_sql, connect

FOLDER = "/root/testdata/sf0.01"
CHECKS = corpus.oracle_sql()


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, name):
    assert assert_equals_sql(corpus.queries()[name](spark, FOLDER), connect(FOLDER), CHECKS[name]) > 0


def test_one_query_per_operator():
    assert [int(n[2:].split("_")[0]) for n in corpus.queries()] == list(range(1, 14))
