"""The driver contract: names, and results against DuckDB."""

import duckdb
import pytest

from civicframe.plans import registry
from tests.conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def canonical(df):
    return sorted(str(tuple(map(str, r))) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_equal_their_sql(spark, duck, name):
    got, expected = registry.queries()[name](spark, SMALL).toPandas(), duck.execute(registry.oracle_sql()[name]).df()
    for df in (got, expected):
        for c in df.columns:
            if "datetime" in str(df[c].dtype):
                df[c] = df[c].dt.date
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_other_queries_run(spark, name):
    assert registry.queries()[name](spark, SMALL).count() >= 0


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
