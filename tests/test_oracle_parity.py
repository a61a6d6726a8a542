"""Every registered key equals its DuckDB oracle (rows, columns, values) on sf0.001."""

import math

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry
from pulsekit.plans.oracle_sql import ORACLES
from pulsekit.plans.registry import QUERIES
from tests.conftest import SF_SMALL

TABLES = ["events", "customer"]


def _norm(v):
    if v is None:
        return None
    if not isinstance(v, (str, bytes)) and pd.isna(v):
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s[:10] if s.endswith("T00:00:00") else s.replace("T", " ")
    return v


def _rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)]
    return cols, sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_key_has_an_oracle_or_is_listed():
    rows_only = set()
    assert set(QUERIES) - set(ORACLES) == rows_only


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns[:3] == ["event_date", "dimension", "dimension_value"]
    assert df.count() == 11


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_key_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    rel = con.sql(ORACLES[key])
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    assert spark_types == {n: str(t) for n, t in zip(rel.columns, rel.types)}
    got = sdf.toPandas()
    want = rel.fetchdf()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
