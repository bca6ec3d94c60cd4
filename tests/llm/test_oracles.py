"""Every query with SQL against DuckDB on whole tables."""

from collections import Counter

import duckdb
import pytest

from brute import SF
from transitlens.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE[key])
    cols = [d[0] for d in cur.description]
    df = QUERIES[key](spark, SF)
    assert sorted(cols) == sorted(df.columns)
    kinds = dict(zip(cols, map(str, con.sql(ORACLE[key]).types)))
    names = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}
    assert {c: names[t] for c, t in df.dtypes} == kinds
    assert Counter(tuple(r) for r in df.select(*cols).collect()) == Counter(cur.fetchall())
