"""Every registered query against its DuckDB oracle on the smallest driver
tables (the driver repeats this at sf0.01)."""

import datetime as dt
import decimal
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as se
from casebook import plans
from casebook.sources.tables import TABLES
from tests.conftest import SMALL

# the study queries; the optional corpus queries are tested in their own folder
QUERIES = {k: v for k, v in se.queries().items() if k in plans.QUERIES}
ORACLE = {k: v for k, v in se.oracle_sql().items() if k in plans.QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", v.normalize())
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return v


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) == set(plans.QUERIES)


@pytest.mark.parametrize("qid", sorted(ORACLE))
def test_matches_oracle(spark, con, qid):
    df = QUERIES[qid](spark, SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    res = con.execute(ORACLE[qid])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want


_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("qid", sorted(ORACLE))
def test_column_types_match_oracle(spark, con, qid):
    df = QUERIES[qid](spark, SMALL)
    want = {d[0]: str(d[1]) for d in con.execute(ORACLE[qid]).description}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert _DUCK.get(t, t.upper()) == want[f.name], f.name


@pytest.mark.parametrize("qid", ["bt_02", "bt_06", "db_10", "dm_04", "ff_12", "pr_19", "dn_01",
                                 "bt_09", "cb_10", "pr_07", "ff_06_intended"])
def test_pandas_transfer_agrees(spark, con, qid):
    """Through pandas (Arrow) too, both sides give the same dtypes for numeric
    columns (money and nullable integers arrive as float64)."""
    s = QUERIES[qid](spark, SMALL).toPandas()
    d = con.execute(ORACLE[qid]).df()
    for c in s.columns:
        if str(s[c].dtype).startswith(("float", "int")):
            assert str(d[c].dtype) == str(s[c].dtype), c
    num = [c for c in s.columns if str(s[c].dtype).startswith("float")]
    key = sorted(s.columns)
    a = s[key].sort_values(key).reset_index(drop=True)
    b = d[key].sort_values(key).reset_index(drop=True)
    for c in num:
        assert (a[c].fillna(-1.0) == b[c].fillna(-1.0)).all(), c
