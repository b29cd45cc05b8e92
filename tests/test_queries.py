"""Every registered query against its SQL in another engine."""

import duckdb
import pytest

from tallyfield.plans import registry
from tallyfield.plans.reports import EXAMPLE_SQL, EXAMPLES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, duck, name):
    compare(registry.queries()[name](spark, FOLDER), duck.execute(registry.oracle_sql()[name]))


def compare(df, result):
    columns = sorted(df.columns)
    made = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert made == sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(EXAMPLES))
def test_example_equals_its_rows(spark, duck, name):
    """Functions over rows of their own, which are no registered queries."""
    assert name not in registry.queries()
    compare(EXAMPLES[name](spark, FOLDER), duck.execute(EXAMPLE_SQL[name]))


def test_flagship_is_registered():
    assert registry.FLAGSHIP in registry.queries()
