"""Every query with SQL returns what DuckDB returns."""

import math
from decimal import Decimal

import duckdb
import pytest

from concordat.plans import catalog_queries, check_queries, dialect_queries, form_queries, function_queries, object_queries, parity_queries, rule_queries, view_queries, witness_queries, write_queries  # noqa: F401
from concordat.plans.registry import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (float, Decimal)):
        return "nan" if math.isnan(v) else float(f"{float(v):.9g}")
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    found = duck.sql(ORACLE_SQL[name])
    assert sorted(found.columns) == columns
    places = [found.columns.index(c) for c in columns]
    assert ours == sorted((tuple(plain(r[i]) for i in places) for r in found.fetchall()), key=repr)


def test_entry_lists_queries_and_their_sql():
    import __spark_entry__ as entry

    assert set(ORACLE_SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
