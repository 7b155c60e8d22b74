"""As written vs intended: a tiny input on which the two readings differ
"""

import datetime as dt
from decimal import Decimal as Dec
from types import SimpleNamespace

from casebook.plans import QUERIES
from casebook.sources.studies import OPEN_END

Q = QUERIES                 # the library registry: exact DECIMAL results
D = dt.date


def _bank(spark, txns, nodes=()):
    return SimpleNamespace(
        regions=spark.createDataFrame([(1, "r1")], "region_id int, region_name string"),
        customer_nodes=spark.createDataFrame(
            list(nodes), "customer_id bigint, region_id int, node_id int, start_date date, end_date date"),
        customer_transactions=spark.createDataFrame(
            txns, "customer_id bigint, txn_date date, txn_type string, txn_amount decimal(12,2)"))


def test_db_09_drops_a_month_without_deposit(spark):
    t = [(1, D(2020, 1, 3), "deposit", Dec(100)), (1, D(2020, 2, 3), "purchase", Dec(30)),
         (1, D(2020, 3, 3), "deposit", Dec(10))]
    b = _bank(spark, t)
    as_written = {r["month"]: r["left_over"] for r in Q["db_09"](spark, b).collect()}
    fixed = {r["month"]: r["left_over"] for r in Q["db_10"](spark, b).collect()}
    assert as_written == {1: 100, 2: 100, 3: 110}          # February's purchase is lost
    assert fixed == {"2020-01": 100, "2020-02": 70, "2020-03": 80}
    spine = {r["month"]: r["closing_balance"] for r in Q["db_09_intended"](spark, b).collect()}
    assert spine == {D(2020, 1, 1): 100, D(2020, 2, 1): 70, D(2020, 3, 1): 80}


def test_db_05_open_allocations(spark):
    nodes = [(c, 1, 1, D(2020, 1, 1), D(2020, 1, 1) + dt.timedelta(days=c)) for c in range(1, 10)]
    nodes.append((10, 1, 1, D(2020, 1, 1), OPEN_END))
    b = _bank(spark, [], nodes)
    r = Q["db_05"](spark, b).first()
    assert r["95percentile_duration"] == 9 and r["median_duration"] == 5
    r = Q["db_05_intended"](spark, b).first()              # open end excluded, ceil ranks
    assert (r["median_duration"], r["95percentile_duration"]) == (5, 9)
    assert Q["db_04_intended"](spark, b).first()[0] == 5.0


def test_ff_07_snapshot_day_is_included_when_intended(spark):
    s = spark.createDataFrame(
        [(1, 0, D(1997, 12, 1)), (1, 1, D(1997, 12, 31)), (2, 0, D(1997, 12, 5))],
        "customer_id bigint, plan_id int, start_date date")
    plans = spark.createDataFrame([(0, "trial", None), (1, "basic monthly", None)],
                                  "plan_id int, plan_name string, price decimal(5,2)")
    src = SimpleNamespace(subscriptions=s, plans=plans)
    r = Q["ff_07"](spark, src).first()
    assert (r["num_of_plan0"], r["num_of_plan1"]) == (2, 0)
    got = {x["plan_id"]: x["customer_count"] for x in Q["ff_07_intended"](spark, src).collect()}
    assert got == {0: 1, 1: 1}


def test_cb_08_add_count_reads_purchases_as_written(spark):
    ev = spark.createDataFrame(
        [("v1", 10, 3, 1, 1, dt.datetime(2024, 1, 2)), ("v1", 10, 3, 2, 2, dt.datetime(2024, 1, 2)),
         ("v2", 20, 4, 3, 3, dt.datetime(2024, 1, 3))],
        "visit_id string, cookie_id bigint, page_id int, event_type int, sequence_number bigint, "
        "event_time timestamp_ntz")
    pages = spark.createDataFrame([(3, "g1", 1), (4, "g1", 2)], "page_id int, product_category string, product_id int")
    src = SimpleNamespace(events=ev, page_hierarchy=pages, users=None, campaign_identifier=None)
    r = Q["cb_08"](spark, src).first()
    assert (r["view_count"], r["add_count"]) == (1, 1)      # v2's purchase
    r = Q["cb_08_intended"](spark, src).first()
    assert (r["view_count"], r["add_count"]) == (1, 1)      # v1's cart add
    f = {x["product_id"]: x for x in Q["cb_10"](spark, src).collect()}
    assert f[1]["number_of_addition_but_not_purchased"] == 1 and f[2]["number_of_purchases"] == 1


def test_bt_07_percent_vs_amount(spark):
    sales = spark.createDataFrame(
        [(1, 1, 2, Dec(10), 10, "t"), (1, 2, 1, Dec(100), 0, "t"), (2, 1, 1, Dec(50), 20, "f")],
        "txn_id bigint, prod_id bigint, qty int, price decimal(12,2), discount int, member string")
    src = SimpleNamespace(sales_raw=sales, product_details=None)
    assert Q["bt_07"](spark, src).first()[0] == (5 + 20) / 2            # mean of per-txn mean percents
    assert Q["bt_07_intended"](spark, src).first()[0] == (2 + 10) / 2   # mean discount amount
    r = Q["bt_08"](spark, src).first()
    assert (r["percentage_of_nonmember_trans"], r["percentage_of_member_trans"]) == (50.0, 50.0)
