import duckdb
import pytest

import __spark_entry__ as entry
from sluice.llm.queries import ORACLE, QUERIES
from tools.oracle_check import TABLES, rows_of


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, tables, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet')")
    df = QUERIES[name](spark, tables)
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cur.fetchall())


def test_all_are_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(ORACLE) <= set(entry.oracle_sql())
