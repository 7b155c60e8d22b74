
import random
from types import SimpleNamespace

import pytest

from casebook.plans import QUERIES
from tests import fixtures
from tests.conftest import SMALL

Q = QUERIES                 # the library registry: exact DECIMAL results


@pytest.mark.parametrize("qid,group", [("bt_15", None), ("bt_16", "segment_name"), ("bt_17", "category_name")])
def test_shares_sum_to_100(spark, qid, group):
    rows = Q[qid](spark, SMALL).collect()
    col = [c for c in rows[0].asDict() if "percentage" in c][0]
    sums = {}
    for r in rows:
        k = r[group] if group else None
        sums[k] = sums.get(k, 0.0) + r[col]
    assert all(abs(v - 100.0) < 1e-9 for v in sums.values())


@pytest.mark.parametrize("qid", ["cb_10", "cb_11", "cb_12"])
def test_funnel_not_purchased_within_cart_adds(spark, qid):
    for r in Q[qid](spark, SMALL).collect():
        d = r.asDict()
        np_ = [v for k, v in d.items() if "not_purchased" in k][0]
        assert 0 <= np_ <= d["number_of_cart_addition"]


def test_last_running_balance_is_the_signed_total(spark):
    bal = {}
    for r in Q["db_10"](spark, SMALL).collect():
        if r["customer_id"] not in bal or r["month"] > bal[r["customer_id"]][0]:
            bal[r["customer_id"]] = (r["month"], r["left_over"])
    from casebook.plans import bank
    t = bank.views(spark, SMALL).customer_transactions.collect()
    tot = {}
    for r in t:
        s = r["txn_amount"] if r["txn_type"] == "deposit" else -r["txn_amount"]
        tot[r["customer_id"]] = tot.get(r["customer_id"], 0) + s
    assert {k: v[1] for k, v in bal.items()} == tot


def test_top_k_is_a_prefix_of_the_full_ranking(spark):
    from pyspark.sql import functions as F

    from casebook.plans import funnel
    top = [(r["page_id"], r["number_of_views"]) for r in Q["cb_07"](spark, SMALL).collect()]
    full = (funnel.views(spark, SMALL).events.groupBy("page_id")
            .agg(F.countDistinct("visit_id").alias("n")).orderBy(F.desc("n"), "page_id").collect())
    assert top == [(r["page_id"], r["n"]) for r in full[:3]]


@pytest.mark.parametrize("qid", ["dn_03", "dn_05", "dn_07", "dn_09", "dn_10"])
def test_input_row_order_does_not_matter(spark, qid):
    rows = list(fixtures.DINER_SALES)
    random.Random(7).shuffle(rows)
    base = fixtures.diner(spark)
    shuffled = SimpleNamespace(**vars(base))
    shuffled.sales = spark.createDataFrame(rows, "customer_id string, order_date date, product_id int").repartition(3)
    a = sorted(map(tuple, Q[qid](spark, base).collect()))
    b = sorted(map(tuple, Q[qid](spark, shuffled).collect()))
    assert a == b
