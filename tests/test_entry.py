"""Driver contract, and every registered key against DuckDB at sf0.001."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from transitlens.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 17


def test_every_key_has_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", ["predictions_rejected", "stream_rejected", "trains_on_lines", "route_paths", "ref_lines"])
def test_oracles_can_fail(con, key):
    """Not empty, and not the unfiltered table."""
    n = len(con.execute(ORACLE[key]).fetchall())
    whole = {"trains_on_lines": "train_positions", "route_paths": "ref_line_routes"}.get(key)
    assert n > 0 and (whole is None or n < len(con.execute(ORACLE[whole]).fetchall()))


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}") if not math.isnan(v) else "nan"
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_key_matches_duckdb(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    cur = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    s_order = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    d_order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = Counter(tuple(_norm(r[i]) for i in s_order) for r in sdf.collect())
    b = Counter(tuple(_norm(r[i]) for i in d_order) for r in cur.fetchall())
    assert a == b
