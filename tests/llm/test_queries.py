"""Each registered query of the package against its SQL, on the smallest tables."""
import duckdb
import pytest

import __spark_entry__ as E
from hostlake.llm import queries as Q

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def norm(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF)
    res = con.execute(Q.ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(repr([norm(r[cols.index(c)]) for c in sorted(cols)]) for r in res.fetchall())
    assert sorted(repr([norm(r[c]) for c in sorted(cols)]) for r in df.collect()) == want


def test_all_registered():
    assert {n.split("_")[0] for n in Q.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(Q.QUERIES) | {"pipeline"} <= set(E.queries()) and set(Q.ORACLE) <= set(E.oracle_sql())
