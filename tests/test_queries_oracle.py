"""Every registered query against its DuckDB oracle on the smallest supplied tables."""

import os
from collections import Counter

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables not present")


def test_all_queries_match_oracle(spark):
    import duckdb

    import __spark_entry__ as entry
    from tools.oracle_check import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    from sluice.plans.registry import QUERIES

    every, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(every)
    # the corpus queries have tests of their own
    qs = {name: fn for name, fn in every.items() if name in QUERIES}
    sqls = {name: sql for name, sql in sqls.items() if name in qs}
    bad = []
    for name, fn in qs.items():
        df = fn(spark, SF)
        rows = df.collect()
        if name not in sqls:
            continue
        cur = con.execute(sqls[name])
        ocols = [d[0] for d in cur.description]
        if sorted(df.columns) != sorted(ocols) or rows_of(df.columns, rows) != rows_of(ocols, cur.fetchall()):
            bad.append(name)
    assert bad == []


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() >= 0 and "event_type" in df.columns
    assert isinstance(Counter(), Counter)
