"""Registered corpus queries that SQL can express, against DuckDB on whole tables."""

import math

import duckdb
import pytest

from tests.conftest import SF001, SF01
from wakeline.llm.queries import ORACLE_SQL, QUERIES


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = lambda v: repr(round(v, 9)) if isinstance(v, float) and not math.isnan(v) else repr(v)
    return sorted("|".join(shown(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("sf_dir", [SF001, SF01])
def test_query_equals_sql(spark, name, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = QUERIES[name](spark, sf_dir)
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(columns, want.fetchall())


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
