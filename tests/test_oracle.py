"""Every registered query against its SQL counterpart: names, types and all rows."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from tickloom.plans import REGISTRY

QUERIES = {name: plan for name, plan in entry_module.queries().items() if name in REGISTRY}
ORACLE = {name: sql for name, sql in entry_module.oracle_sql().items() if name in REGISTRY}

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else v
        return v

    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, duck, sf_dir):
    result = QUERIES[name](spark, sf_dir)
    got = rows_of(result.columns, result.collect())
    types = {f.name: TYPES[f.dataType.simpleString()] for f in result.schema.fields}
    described = duck.execute(f"describe {ORACLE[name]}").fetchall()
    assert {r[0]: r[1] for r in described} == types
    expected = duck.execute(ORACLE[name]).fetchall()
    assert len(expected) > 0, "the comparison says nothing without rows"
    want = rows_of([r[0] for r in described], expected)
    assert got == want, f"missing {list((want - got).items())[:3]}, extra {list((got - want).items())[:3]}"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
