"""Driver contract: entry smoke and oracle parity on a subset at sf0.001."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["k", "partition", "offset", "event_id", "user_id", "event_type", "amount"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert set(E.oracle_sql()) <= set(E.queries())
    own = {q for q in set(E.queries()) - set(E.oracle_sql()) if not q.startswith("op") and q != "pipeline"}
    assert own == set()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.mark.parametrize("name", [q for q in E.oracle_sql() if not q.startswith("op") and q != "pipeline"])
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("events", "nation", "documents", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    cols = sorted(df.columns)
    ocols = [d[0] for d in res.description]
    assert cols == sorted(ocols)
    a = sorted(tuple(str(_norm(r[c])) for c in cols) for r in df.collect())
    b = sorted(tuple(str(_norm(r[ocols.index(c)])) for c in cols) for r in res.fetchall())
    assert a == b
