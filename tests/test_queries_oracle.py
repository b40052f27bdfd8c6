"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01), plus the entry contract."""

import os

import duckdb
import pytest

from conftest import SF_SMALL
from lodestone.plans import registry
from tools.check import TABLES, family, rows_key

import __spark_entry__ as entry

registry.load_all()
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["type_name", "total_tons", "avg_per_shift", "shift_count", "total_fuel"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(QUERIES) == set(ORACLE), sorted(set(QUERIES) - set(ORACLE))


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    s_cols = df.columns
    s_types = {f.name: family(f.dataType.simpleString()) for f in df.schema.fields}
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[key])
    d_cols = [c[0] for c in cur.description]
    d_types = {c[0]: family(str(c[1])) for c in cur.description}
    d_rows = [tuple(r) for r in cur.fetchall()]
    assert sorted(s_cols) == sorted(d_cols)
    assert s_types == d_types
    assert len(s_rows) == len(d_rows)
    assert rows_key(s_cols, s_rows, 6) == rows_key(d_cols, d_rows, 6)
