"""Every registered query against its DuckDB statement on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.check_oracle import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_sql(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "health_class" in df.columns


SAME_TYPE = {("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"),
             ("string", "VARCHAR"), ("boolean", "BOOLEAN")}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_column_types_match_sql(spark, con, name):
    spark_types = {f.name: f.dataType.simpleString()
                   for f in E.queries()[name](spark, SF_SMALL).schema.fields}
    rel = con.sql(E.oracle_sql()[name])
    sql_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: (t, sql_types.get(c)) for c, t in spark_types.items()
            if (t, sql_types.get(c)) not in SAME_TYPE} == {}
