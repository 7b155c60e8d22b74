"""Golden values of FIXTURES.md on the studies' own sample data."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest

from casebook.plans import QUERIES
from casebook.plans import delivery, diner
from tests import fixtures

Q = QUERIES                 # the library registry: exact DECIMAL results


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


@pytest.fixture()
def dn(spark, monkeypatch):
    monkeypatch.setattr(diner, "SPECIAL", "sushi")
    monkeypatch.setattr(diner, "POINTS_CUTOFF", dt.date(2021, 1, 31))
    return fixtures.diner(spark)


@pytest.fixture()
def pr(spark, monkeypatch):
    monkeypatch.setattr(delivery, "TOPPING", "Cheese")
    return fixtures.delivery(spark)


def test_dn_01_02(spark, dn):
    assert as_dict(Q["dn_01"](spark, dn), "customer_id", "total_spent") == {"A": 76, "B": 74, "C": 36}
    assert as_dict(Q["dn_02"](spark, dn), "customer_id", "number_of_days") == {"A": 4, "B": 6, "C": 2}


def test_dn_03_first_item(spark, dn):
    # A bought sushi and curry on its first day: one row, ties by product id
    assert rows(Q["dn_03"](spark, dn), "customer_id", "product_name") == [
        ("A", "sushi"), ("B", "curry"), ("C", "ramen")]
    assert rows(Q["dn_03_intended"](spark, dn), "customer_id", "product_name") == [
        ("A", "curry"), ("A", "sushi"), ("B", "curry"), ("C", "ramen"), ("C", "ramen")]


def test_dn_04_05(spark, dn):
    assert rows(Q["dn_04"](spark, dn), "customer_id", "product_id", "number_of_purchases") == [
        ("A", 3, 3), ("B", 3, 2), ("C", 3, 3)]
    assert rows(Q["dn_04_intended"](spark, dn), "product_id", "number_of_purchases") == [(3, 8)]
    assert rows(Q["dn_05"](spark, dn), "customer_id", "product_id") == [("A", 3), ("B", 3), ("C", 3)]
    assert rows(Q["dn_05_intended"](spark, dn), "customer_id", "product_id") == [
        ("A", 3), ("B", 1), ("B", 2), ("B", 3), ("C", 3)]


def test_dn_06_07_around_joining(spark, dn):
    assert rows(Q["dn_06"](spark, dn), "customer_id", "product_id", "order_date") == [
        ("A", 3, dt.date(2021, 1, 10)), ("B", 1, dt.date(2021, 1, 11))]
    # divergence: on the join day itself A bought curry
    assert rows(Q["dn_06_intended"](spark, dn), "customer_id", "product_id", "order_date") == [
        ("A", 2, dt.date(2021, 1, 7)), ("B", 1, dt.date(2021, 1, 11))]
    assert rows(Q["dn_07"](spark, dn), "customer_id", "product_id", "order_date") == [
        ("A", 2, dt.date(2021, 1, 1)), ("B", 1, dt.date(2021, 1, 4))]
    assert rows(Q["dn_07_intended"](spark, dn), "customer_id", "product_id") == [("A", 1), ("A", 2), ("B", 1)]


def test_dn_08_to_10_points(spark, dn):
    assert rows(Q["dn_08"](spark, dn), "customer_id", "total_items", "amount_spent") == [
        ("A", 2, 25), ("B", 3, 40)]
    assert as_dict(Q["dn_09"](spark, dn), "customer_id", "points") == {"A": 860, "B": 940, "C": 360}
    assert as_dict(Q["dn_10"](spark, dn), "customer_id", "points") == {"A": 1370, "B": 1180}
    assert as_dict(Q["dn_10_intended"](spark, dn), "customer_id", "points") == {"A": 1370, "B": 820}


def test_pr_cleaning(spark, pr):
    ro = {r["order_id"]: r for r in Q["pr_c9"](spark, pr).collect()}
    assert [ro[i]["distance"] for i in (1, 3, 6, 8)] == ["20", "13.4", None, "23.4"]
    assert [ro[i]["duration"] for i in (1, 3, 7, 8, 10)] == ["32", "20", "25", "15", "10"]
    assert [ro[i]["cancellation"] for i in (1, 6, 7)] == [None, "Restaurant Cancellation", None]
    # PR-C8 leaves the 's' of 'minutes' for PR-C9
    assert {r["order_id"]: r["duration"] for r in Q["pr_c8"](spark, pr).collect()}[1] == "32s"
    co = Q["pr_c2"](spark, pr).collect()
    assert sum(r["exclusions"] is None for r in co) == 9 and sum(r["extras"] is None for r in co) == 10


def test_pr_counts(spark, pr):
    assert Q["pr_01"](spark, pr).first()[0] == 8
    assert Q["pr_01_intended"](spark, pr).first()[0] == 14
    assert Q["pr_02"](spark, pr).first()[0] == 5
    assert Q["pr_02_intended"](spark, pr).first()[0] == 10
    assert as_dict(Q["pr_03"](spark, pr), "runner_id", "number_of_orders") == {1: 4, 2: 3, 3: 1}
    assert as_dict(Q["pr_04"](spark, pr), "pizza_id", "number_of_deliveries") == {1: 10, 2: 4}
    assert as_dict(Q["pr_04_intended"](spark, pr), "pizza_id", "number_of_deliveries") == {1: 9, 2: 3}
    assert rows(Q["pr_05"](spark, pr), "customer_id", "pizza_name", "number_of_orders") == [
        (101, "Meatlovers", 2), (101, "Vegetarian", 1), (102, "Meatlovers", 2), (102, "Vegetarian", 1),
        (103, "Meatlovers", 3), (103, "Vegetarian", 1), (104, "Meatlovers", 3), (105, "Vegetarian", 1)]
    assert rows(Q["pr_06"](spark, pr), "order_id", "number_of_pizzas") == [(4, 3)]


def test_pr_changes(spark, pr):
    assert rows(Q["pr_07"](spark, pr), "customer_id", "changed_orders", "unchanged_orders") == [
        (101, None, 2), (102, None, 4), (103, 4, None), (104, 2, 1), (105, 2, None)]
    assert rows(Q["pr_07_intended"](spark, pr), "customer_id", "changed_orders", "unchanged_orders") == [
        (101, 0, 2), (102, 0, 3), (103, 3, 0), (104, 2, 1), (105, 1, 0)]
    assert Q["pr_08"](spark, pr).first()[0] == 1
    assert Q["pr_08_intended"](spark, pr).first()[0] == 1


def test_pr_time(spark, pr):
    assert as_dict(Q["pr_09"](spark, pr), "dayhour", "number_of_pizzas") == {
        11: 1, 13: 3, 18: 3, 19: 1, 21: 3, 23: 3}
    assert as_dict(Q["pr_10"](spark, pr), "weekday", "number_of_pizzas") == {2: 5, 3: 3, 4: 1, 5: 5}
    got = as_dict(Q["pr_11"](spark, pr), "runner_id", "avg_del_time")
    assert got[1] == 22.25 and round(got[2], 3) == 26.667 and got[3] == 15
    assert Counter((r["number_of_pizzas"], r["avg_prep_time"]) for r in Q["pr_12"](spark, pr).collect()) == Counter(
        [(1, 10), (1, 10), (2, 21), (3, 29), (1, 10), (1, 10), (1, 20), (2, 15)])
    d = {k: round(v, 3) for k, v in as_dict(Q["pr_13"](spark, pr), "customer_id", "avg_distance").items()}
    assert d == {101: 20, 102: 16.733, 103: 23.4, 104: 10, 105: 25}
    assert Q["pr_14"](spark, pr).first()[0] == 30
    assert Q["pr_14_intended"](spark, pr).first()[0] == 30


def test_pr_rates_and_revenue(spark, pr):
    assert as_dict(Q["pr_16"](spark, pr), "runner_id", "delivery_success_percentage") == {1: 100, 2: 75, 3: 50}
    assert Q["pr_17"](spark, pr).first()[0] == 126
    assert Q["pr_17_intended"](spark, pr).first()[0] == 138
    assert as_dict(Q["pr_18"](spark, pr), "pizza_id", "topping_position") == {1: 0, 2: 1}
    assert as_dict(Q["pr_18_intended"](spark, pr), "pizza_id", "topping_position") == {1: 4, 2: 1}
    assert Q["pr_19"](spark, pr).first()[0] == Decimal("94.44")
    speeds = as_dict(Q["pr_15"](spark, pr), "order_id", "speed_of_delivery_in_km_per_min")
    assert round(speeds[1], 4) == round(20 / 32, 4) and 6 not in speeds


def test_pr_cleaning_leaves_no_unparseable_text(spark, pr):
    from casebook.functions.clean import reject_counts
    r = reject_counts(Q["pr_c9"](spark, pr), {"distance": "decimal(10,1)", "duration": "int",
                                             "pickup_time": "timestamp_ntz"}).first()
    assert tuple(r) == (0, 0, 0)
    raw = reject_counts(pr.runner_orders_raw, {"distance": "decimal(10,1)", "duration": "int"}).first()
    assert raw["distance_rejects"] > 0 and raw["duration_rejects"] > 0
