"""The studies' questions for other dates, products and prices: each query
with an argument against its SQL with the value replaced."""

import datetime as dt

import duckdb
import pytest

from casebook.plans import ORACLE, QUERIES
from casebook.sources.tables import TABLES
from tests.conftest import SMALL
from tests.test_oracle_parity import _norm

NEW = dt.date(1996, 3, 4)
CASES = [
    ("dn_09", {"special": "blue widget"}, {"red plate": "blue widget"}),
    ("dn_10", {"special": "blue widget"}, {"red plate": "blue widget"}),
    ("dn_10_intended", {"cutoff": dt.date(1999, 5, 31)}, {"1998-01-31": "1999-05-31"}),
    ("dm_10", {"baseline": dt.date(1997, 3, 3), "weeks": 6}, {"1998-08-10": "1997-03-03", "1998-07-13": "1997-01-20", "1998-09-07": "1997-04-14"}),
    ("dm_11_intended", {"baseline": dt.date(1997, 3, 3), "weeks": 2}, {"1998-06-15": "1997-03-03", "84": "14"}),
    ("ff_03", {"cutoff": NEW}, {"1998-01-01": "1996-03-04"}),
    ("ff_07", {"day": NEW}, {"1997-12-31": "1996-03-04"}),
    ("ff_07_intended", {"day": NEW}, {"1997-12-31": "1996-03-04"}),
    ("ff_08_intended", {"first": NEW, "before": dt.date(1999, 1, 1)}, {"1997-01-01": "1996-03-04", "1998-01-01": "1999-01-01"}),
    ("ff_11", {"before": NEW}, {"1998-01-01": "1996-03-04"}),
    ("ff_12", {"credit": "12.34"}, {"9.90 ": "12.34 ", "- 9.90": "- 12.34"}),
    ("pr_17", {"prices": ({1: 7, 2: 8}, 9)}, {"case when pizza_id = 1 then 10 * n else 12 * n end": "case pizza_id when 1 then 7 when 2 then 8 else 9 end * n"}),
    ("pr_18_intended", {"topping": "NATION_7"}, {"NATION_3": "NATION_7"}),
]


@pytest.mark.parametrize("qid, arguments, values", CASES, ids=[c[0] for c in CASES])
def test_other_values(spark, qid, arguments, values):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    sql = ORACLE[qid]
    for old, new in values.items():
        assert old in sql or old == "9.90 "
        sql = sql.replace(old, new)
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = sorted((tuple(_norm(v) for v in r) for r in res.fetchall()), key=repr)
    df = QUERIES[qid](spark, SMALL, **arguments)
    got = sorted((tuple(_norm(r[n]) for n in names) for r in df.collect()), key=repr)
    assert got == want and got
    assert got != sorted((tuple(_norm(r[n]) for n in names) for r in QUERIES[qid](spark, SMALL).collect()), key=repr)
