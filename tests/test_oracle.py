"""Every registered query against its DuckDB oracle on the same tables."""

import datetime
import glob
import math
import os

import duckdb
import pytest

from logtide.plans import QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp": "TIMESTAMP",
         "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf, "*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.oracle))
def test_matches_oracle(spark, duck, sf, name):
    query = QUERIES[name]
    df = query.plan(spark, sf)
    relation = duck.sql(query.oracle)
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    at = [relation.columns.index(c) for c in columns]
    want = sorted(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    assert len(got) > 0
    assert got == want


def test_queries_without_oracle(spark, sf):
    sizes = {r.codec: r for r in QUERIES["codec_footprint"].plan(spark, sf).collect()}
    assert set(sizes) == {"none", "gzip", "lz4", "zstd"}
    assert sizes["none"].ratio == 1.0
    assert all(sizes[c].bytes < sizes["none"].bytes for c in ("gzip", "zstd"))
