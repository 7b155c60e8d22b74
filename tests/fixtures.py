"""The small shipped study tables (diner, delivery), as test inputs.

Fixed values: these rows are the studies' own sample data, kept verbatim so
the golden values of FIXTURES.md can be checked.
"""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

D = dt.date
T = dt.datetime.fromisoformat

DINER_SALES = [
    ("A", D(2021, 1, 1), 1), ("A", D(2021, 1, 1), 2), ("A", D(2021, 1, 7), 2), ("A", D(2021, 1, 10), 3),
    ("A", D(2021, 1, 11), 3), ("A", D(2021, 1, 11), 3), ("B", D(2021, 1, 1), 2), ("B", D(2021, 1, 2), 2),
    ("B", D(2021, 1, 4), 1), ("B", D(2021, 1, 11), 1), ("B", D(2021, 1, 16), 3), ("B", D(2021, 2, 1), 3),
    ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 7), 3),
]
DINER_MENU = [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)]
DINER_MEMBERS = [("A", D(2021, 1, 7)), ("B", D(2021, 1, 9))]

CUSTOMER_ORDERS = [
    (1, 101, 1, "", "", "2020-01-01 18:05:02"),
    (2, 101, 1, "", "", "2020-01-01 19:00:52"),
    (3, 102, 1, "", "", "2020-01-02 23:51:23"),
    (3, 102, 2, "", None, "2020-01-02 23:51:23"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 2, "4", "", "2020-01-04 13:23:46"),
    (5, 104, 1, "null", "1", "2020-01-08 21:00:29"),
    (6, 101, 2, "null", "null", "2020-01-08 21:03:13"),
    (7, 105, 2, "null", "1", "2020-01-08 21:20:29"),
    (8, 102, 1, "null", "null", "2020-01-09 23:54:33"),
    (9, 103, 1, "4", "1, 5", "2020-01-10 11:22:59"),
    (10, 104, 1, "null", "null", "2020-01-11 18:34:49"),
    (10, 104, 1, "2, 6", "1, 4", "2020-01-11 18:34:49"),
]
RUNNER_ORDERS = [
    (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
    (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
    (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None),
    (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
    (5, 3, "2020-01-08 21:10:57", "10", "15", None),
    (6, 3, "null", "null", "null", "Restaurant Cancellation"),
    (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"),
    (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", "null"),
    (9, 2, "null", "null", "null", "Customer Cancellation"),
    (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", "null"),
]
PIZZA_NAMES = [(1, "Meatlovers"), (2, "Vegetarian")]
PIZZA_RECIPES = [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")]
PIZZA_TOPPINGS = [
    (1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"), (6, "Mushrooms"),
    (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"), (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce"),
]


def diner(spark) -> SimpleNamespace:
    return SimpleNamespace(
        sales=spark.createDataFrame(DINER_SALES, "customer_id string, order_date date, product_id int"),
        menu=spark.createDataFrame(DINER_MENU, "product_id int, product_name string, price int"),
        members=spark.createDataFrame(DINER_MEMBERS, "customer_id string, join_date date"),
    )


def delivery(spark) -> SimpleNamespace:
    co = [r[:5] + (T(r[5]),) for r in CUSTOMER_ORDERS]
    return SimpleNamespace(
        customer_orders_raw=spark.createDataFrame(
            co, "order_id int, customer_id int, pizza_id int, exclusions string, extras string, "
                "order_time timestamp_ntz"),
        runner_orders_raw=spark.createDataFrame(
            RUNNER_ORDERS, "order_id int, runner_id int, pickup_time string, distance string, "
                           "duration string, cancellation string"),
        pizza_names=spark.createDataFrame(PIZZA_NAMES, "pizza_id int, pizza_name string"),
        pizza_recipes=spark.createDataFrame(PIZZA_RECIPES, "pizza_id int, toppings string"),
        pizza_toppings=spark.createDataFrame(PIZZA_TOPPINGS, "topping_id int, topping_name string"),
    )
