"""Registered queries against their DuckDB twins on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as S

SF = "/root/testdata/sf0.001"
#: The queries of the engine; those of the optional operators are tested beside them.
ALL = sorted(S._QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in sorted(f.removesuffix(".parquet") for f in os.listdir(SF)):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(ALL) <= set(S.oracle_sql()) and set(S.oracle_sql()) <= set(S.queries())


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", ALL)
def test_query_matches_oracle(spark, con, name):
    df = S.queries()[name](spark, SF)
    res = con.sql(S.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(res.columns, res.types)}
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(res.columns, res.fetchall())


def test_entry_runs(spark):
    df = S.entry(spark)
    assert df.columns == ["title", "rank"]
    assert df.count() > 0
