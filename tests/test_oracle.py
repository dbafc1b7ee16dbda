"""Every registered query against its DuckDB twin on the smallest driver tables."""

import math
import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
#: Queries of the optional subpackage have tests of their own.
NAMES = [n for n in sorted(oracle_sql()) if not re.match(r"op\d+_", n)]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v.isoformat() if hasattr(v, "isoformat") else v


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(oracle_sql()) <= set(queries())
    rest = {n for n in set(queries()) - set(oracle_sql()) if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert rest == {"end_to_end_roundtrip"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    rel = con.sql(oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "ai_narrative" in df.columns
