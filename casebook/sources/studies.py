"""Study views: the seven case-study schemas, derived from the driver tables.

Each ``<study>(t)`` returns a namespace of lazy DataFrames with the column
names and types the study's operators expect. Each ``<STUDY>_SQL`` holds the
same views as DuckDB CTE bodies, used to build the oracle queries. The two
must stay equivalent: both are written with integer arithmetic, exact
decimals and plain string functions so the engines agree bit for bit.

How the driver tables are mapped is documented in README.md.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions.numeric import MONEY, TOTAL, int_div, money
from casebook.operators.period import days_of_weeks
from casebook.operators.sequence import neighbor
from casebook.sources.tables import Tables

OPEN_END = dt.date(9999, 12, 31)


def _date(c) -> F.Column:
    return F.col(c).cast("date")


def _lookup(df: DataFrame, key: str, cols: list[str], alias_key: str | None = None) -> DataFrame:
    """One row per ``key`` with ``cols`` (on a duplicated key the largest row,
    compared column by column, never a mix of rows), for a LEFT join from the fact side. Because the right side is grouped on the
    join key, Catalyst drops the whole join from any query that uses none
    of ``cols``: a study query that never reads, say, the member flag does
    not pay for joining lineitem with orders."""
    one = F.max(cols[0]) if len(cols) == 1 else F.max(F.struct(*cols))
    per = df.groupBy(F.col(key).alias(alias_key or key)).agg(one.alias(cols[0] if len(cols) == 1 else "_row"))
    return per if len(cols) == 1 else per.select(alias_key or key, *[F.col(f"_row.{c}").alias(c) for c in cols])


class LazyViews:
    """Namespace of study views built on first access.

    A query touches one or two of its study's views; building the others
    would still cost plan analysis and parquet footer reads. Each view is a
    thunk run once when read."""

    def __init__(self, **thunks):
        self.__dict__["_thunks"] = dict(thunks)

    def __getattr__(self, name):
        thunks = self.__dict__["_thunks"]
        if name not in thunks:
            raise AttributeError(name)
        value = thunks[name]()
        self.__dict__[name] = value
        return value

    def define(self, name: str, thunk) -> None:
        """Add (or replace) a view built from others on first access."""
        self.__dict__.pop(name, None)
        self.__dict__["_thunks"][name] = thunk

    def copy(self) -> "LazyViews":
        new = LazyViews(**self.__dict__["_thunks"])
        new.__dict__.update({k: v for k, v in self.__dict__.items() if k != "_thunks"})
        return new


# --------------------------------------------------------------------------
# Retail: sales (txn_id, prod_id, qty, price, discount, member),
#         product_details (product_id, product_name, segment_name, category_name)
# --------------------------------------------------------------------------

def retail(t: Tables) -> LazyViews:
    v = LazyViews(
        sales_raw=lambda: _retail_sales(t), product_details=lambda: _retail_products(t),
        # the lines without the flag, and the flag of each transaction, for
        # queries that can aggregate the lines before they look the flag up
        lines=lambda: v.sales_raw.drop("member"),
        txn_members=lambda: _retail_members(t).select(F.col("l_orderkey").alias("txn_id"), F.col("_member").alias("member")))
    return v


def _retail_members(t: Tables) -> DataFrame:
    # the member flag travels as a small integer so the key lookup is a hash
    # aggregate (a string max would need a sort-based aggregate)
    flag = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    return _lookup(t.orders.select("o_orderkey", flag.alias("_member")), "o_orderkey", ["_member"], "l_orderkey")


def _retail_sales(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    o = _retail_members(t)
    qty = F.col("l_quantity").cast("int")
    line_cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    unit_cents = int_div(line_cents, qty.cast("bigint"))
    return li.join(o, "l_orderkey", "left").select(
        F.col("l_orderkey").alias("txn_id"),
        F.col("l_partkey").alias("prod_id"),
        qty.alias("qty"),
        (unit_cents.cast("decimal(18,0)") / 100).cast(MONEY).alias("price"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
        F.when(F.col("_member") == 1, "t").when(F.col("_member") == 0, "f").alias("member"),
    )


def _retail_products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("segment_name"),
        F.col("p_brand").alias("category_name"),
    )


RETAIL_SQL = {
    "bt_sales_raw": """
        select l.l_orderkey as txn_id, l.l_partkey as prod_id,
               cast(l.l_quantity as integer) as qty,
               cast(cast((cast(round(l.l_extendedprice * 100) as bigint)
                          // cast(l.l_quantity as bigint)) as decimal(18,0)) * 0.01 as decimal(12,2)) as price,
               cast(round(l.l_discount * 100) as integer) as discount,
               case o.flag when 1 then 't' when 0 then 'f' end as member
        from lineitem l left join (select o_orderkey, max(case o_orderstatus when 'F' then 1 when 'O' then 0 end) as flag
                                   from orders group by o_orderkey) o on l.l_orderkey = o.o_orderkey""",
    "bt_product_details": """
        select p_partkey as product_id, p_name as product_name,
               p_type as segment_name, p_brand as category_name
        from part""",
    # BT-C1: member text flag to 1 / 0 / NULL
    "bt_sales": """
        select txn_id, prod_id, qty, price, discount,
               case when member = 't' then 1 when member = 'f' then 0 end as member
        from bt_sales_raw""",
}


# --------------------------------------------------------------------------
# Diner: sales (customer_id, order_date, product_id), menu (product_id,
#        product_name, price), members (customer_id, join_date)
# --------------------------------------------------------------------------

def diner(t: Tables) -> LazyViews:
    def sales():
        return t.lineitem.select("l_orderkey", "l_partkey").join(
            t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"), "l_orderkey"
        ).select(
            F.col("o_custkey").alias("customer_id"),
            _date("o_orderdate").alias("order_date"),
            F.col("l_partkey").alias("product_id"),
        )

    def menu():
        return t.part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            money("p_retailprice").alias("price"),
        )

    def members():
        return (t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
                .groupBy(F.col("o_custkey").alias("customer_id"))
                .agg(F.min(_date("o_orderdate")).alias("join_date")))
    def sale_customers():
        return t.orders.select(F.col("o_custkey").alias("customer_id"))
    return LazyViews(sales=sales, menu=menu, members=members, sale_customers=sale_customers)


DINER_SQL = {
    "dn_sales": """
        select o.o_custkey as customer_id, cast(o.o_orderdate as date) as order_date,
               l.l_partkey as product_id
        from lineitem l join orders o on l.l_orderkey = o.o_orderkey""",
    "dn_menu": """
        select p_partkey as product_id, p_name as product_name,
               cast(p_retailprice as decimal(12,2)) as price
        from part""",
    "dn_members": """
        select o_custkey as customer_id, min(cast(o_orderdate as date)) as join_date
        from orders where o_orderpriority = '1-URGENT' group by o_custkey""",
}


# --------------------------------------------------------------------------
# Delivery: customer_orders, runner_orders (dirty text as in the study),
#           pizza_names, pizza_recipes, pizza_toppings
# --------------------------------------------------------------------------

def _order_minute(k):
    # minute of the day the order was placed; fixed per order
    return (k * 37) % 1440


def delivery(t: Tables) -> LazyViews:
    def li():
        return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_tax", "l_discount")

    def o():
        return _lookup(t.orders, "o_orderkey", ["o_custkey", "o_orderdate"], "l_orderkey")
    tax = F.round(F.col("l_tax") * 100).cast("int")
    disc = F.round(F.col("l_discount") * 100).cast("int")
    t1 = ((F.col("l_suppkey") % 25) + 1).cast("string")
    t2 = (((F.col("l_suppkey") + 7) % 25) + 1).cast("string")
    t3 = ((F.col("l_partkey") % 25) + 1).cast("string")
    t4 = (((F.col("l_partkey") + 11) % 25) + 1).cast("string")
    exclusions = (
        F.when(tax == 1, F.lit(""))
        .when(tax.isin(2, 6), F.lit("null"))
        .when(tax.isin(3, 7), t1)
        .when(tax.isin(4, 8), F.concat(t1, F.lit(", "), t2))
    )
    extras = (
        F.when(disc == 4, F.lit(""))
        .when(disc == 5, F.lit("null"))
        .when(disc.isin(6, 7), t3)
        .when(disc == 8, F.concat(t3, F.lit(", "), t4))
    )
    lk = F.col("l_orderkey")
    placed = F.timestamp_add("MINUTE", _order_minute(lk), F.col("o_orderdate"))
    customer_orders = lambda: li().join(o(), "l_orderkey", "left").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("pizza_id"),
        exclusions.alias("exclusions"),
        extras.alias("extras"),
        placed.alias("order_time"),
    )
    # the lines alone, and the time of each order, for queries that can
    # aggregate the lines before they look the time up
    order_lines = lambda: li().select(lk.alias("order_id"), F.col("l_partkey").alias("pizza_id"))
    order_times = lambda: o().select(lk.alias("order_id"), placed.alias("order_time"))

    k = F.col("o_orderkey")
    cancelled = F.col("o_orderstatus") == "P"
    pickup = F.timestamp_add("MINUTE", _order_minute(k) + (k % 30) + 5, F.col("o_orderdate"))
    x = (k % 230) + 20
    km = F.when(x % 10 == 0, int_div(x, F.lit(10)).cast("string")).otherwise(
        F.concat(int_div(x, F.lit(10)).cast("string"), F.lit("."), (x % 10).cast("string")))
    km_unit = F.when(k % 3 == 0, F.lit("km")).when(k % 3 == 1, F.lit(" km")).otherwise(F.lit(""))
    du = int_div(k, F.lit(3)) % 5
    min_unit = (F.when(du == 0, F.lit("minutes")).when(du == 1, F.lit(" minutes"))
                .when(du == 2, F.lit("mins")).when(du == 3, F.lit(" minute")).otherwise(F.lit("")))
    runner_orders = lambda: t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        ((F.col("o_custkey") % 4) + 1).cast("int").alias("runner_id"),
        F.when(cancelled, F.lit("null")).otherwise(
            F.date_format(pickup, "yyyy-MM-dd HH:mm:ss")).alias("pickup_time"),
        F.when(cancelled, F.lit("null")).otherwise(F.concat(km, km_unit)).alias("distance"),
        F.when(cancelled, F.lit("null")).otherwise(
            F.concat(((k % 31) + 10).cast("string"), min_unit)).alias("duration"),
        F.when(cancelled, F.when(k % 2 == 0, F.lit("Restaurant Cancellation"))
               .otherwise(F.lit("Customer Cancellation")))
        .when(k % 3 == 1, F.lit("")).when(k % 3 == 2, F.lit("null")).alias("cancellation"),
    )
    pizza_names = lambda: t.part.select(
        F.col("p_partkey").alias("pizza_id"), F.col("p_name").alias("pizza_name"))
    n_top = (F.col("p_size") % 6) + 2
    toppings = F.array_join(
        F.transform(F.sequence(F.lit(0), n_top - 1),
                    lambda i: (((F.col("p_partkey") + i * 7) % 25) + 1).cast("string")),
        ", ")
    pizza_recipes = lambda: t.part.select(
        F.col("p_partkey").alias("pizza_id"), toppings.alias("toppings"))
    pizza_toppings = lambda: t.nation.select(
        (F.col("n_nationkey") + 1).cast("int").alias("topping_id"),
        F.col("n_name").alias("topping_name"))
    return LazyViews(customer_orders_raw=customer_orders, runner_orders_raw=runner_orders,
                     pizza_names=pizza_names, pizza_recipes=pizza_recipes, pizza_toppings=pizza_toppings,
                     order_lines=order_lines, order_times=order_times)


DELIVERY_SQL = {
    "pr_customer_orders_raw": """
        select l.l_orderkey as order_id, o.o_custkey as customer_id, l.l_partkey as pizza_id,
          case when cast(round(l.l_tax * 100) as integer) = 1 then ''
               when cast(round(l.l_tax * 100) as integer) in (2, 6) then 'null'
               when cast(round(l.l_tax * 100) as integer) in (3, 7) then cast(l.l_suppkey % 25 + 1 as varchar)
               when cast(round(l.l_tax * 100) as integer) in (4, 8)
                 then cast(l.l_suppkey % 25 + 1 as varchar) || ', ' || cast((l.l_suppkey + 7) % 25 + 1 as varchar)
          end as exclusions,
          case when cast(round(l.l_discount * 100) as integer) = 4 then ''
               when cast(round(l.l_discount * 100) as integer) = 5 then 'null'
               when cast(round(l.l_discount * 100) as integer) in (6, 7) then cast(l.l_partkey % 25 + 1 as varchar)
               when cast(round(l.l_discount * 100) as integer) = 8
                 then cast(l.l_partkey % 25 + 1 as varchar) || ', ' || cast((l.l_partkey + 11) % 25 + 1 as varchar)
          end as extras,
          o.o_orderdate + to_minutes(cast((l.l_orderkey * 37) % 1440 as bigint)) as order_time
        from lineitem l left join (select o_orderkey, unnest(max({'o_custkey': o_custkey, 'o_orderdate': o_orderdate}))
                                   from orders group by o_orderkey) o on l.l_orderkey = o.o_orderkey""",
    "pr_runner_orders_raw": """
        select o_orderkey as order_id, cast(o_custkey % 4 + 1 as integer) as runner_id,
          case when o_orderstatus = 'P' then 'null'
               else strftime(o_orderdate + to_minutes(cast((o_orderkey * 37) % 1440 + o_orderkey % 30 + 5 as bigint)),
                             '%Y-%m-%d %H:%M:%S') end as pickup_time,
          case when o_orderstatus = 'P' then 'null'
               else (case when (o_orderkey % 230 + 20) % 10 = 0
                          then cast((o_orderkey % 230 + 20) // 10 as varchar)
                          else cast((o_orderkey % 230 + 20) // 10 as varchar) || '.' || cast((o_orderkey % 230 + 20) % 10 as varchar)
                     end)
                    || (case o_orderkey % 3 when 0 then 'km' when 1 then ' km' else '' end) end as distance,
          case when o_orderstatus = 'P' then 'null'
               else cast(o_orderkey % 31 + 10 as varchar)
                    || (case (o_orderkey // 3) % 5 when 0 then 'minutes' when 1 then ' minutes'
                             when 2 then 'mins' when 3 then ' minute' else '' end) end as duration,
          case when o_orderstatus = 'P' then
                    (case when o_orderkey % 2 = 0 then 'Restaurant Cancellation' else 'Customer Cancellation' end)
               when o_orderkey % 3 = 1 then ''
               when o_orderkey % 3 = 2 then 'null' end as cancellation
        from orders""",
    "pr_pizza_names": "select p_partkey as pizza_id, p_name as pizza_name from part",
    "pr_pizza_recipes": """
        select p_partkey as pizza_id,
          array_to_string(list_transform(range(0, p_size % 6 + 2),
                          lambda i: cast((p_partkey + i * 7) % 25 + 1 as varchar)), ', ') as toppings
        from part""",
    "pr_pizza_toppings": """
        select cast(n_nationkey + 1 as integer) as topping_id, n_name as topping_name from nation""",
    # PR-C1..C9 applied in order: null tokens, then unit stripping
    "pr_customer_orders": None,
    "pr_runner_orders": None,
}


# Cleaning steps as (column, new expression), applied in order.
CUSTOMER_ORDER_STEPS_SQL = [
    ("exclusions", "case when exclusions not in ('null', '') then exclusions end"),     # PR-C1
    ("extras", "case when extras not in ('null', '') then extras end"),                 # PR-C2
]
RUNNER_ORDER_STEPS_SQL = [
    ("duration", "case when duration <> 'null' then duration end"),                     # PR-C3
    ("cancellation", "case when cancellation not in ('null', '') then cancellation end"),  # PR-C4
    ("distance", "case when distance <> 'null' then distance end"),                     # PR-C5
    ("pickup_time", "case when pickup_time <> 'null' then pickup_time end"),            # PR-C6
    ("distance", "trim(regexp_replace(distance, 'km| ', '', 'g'))"),                    # PR-C7
    ("duration", "trim(regexp_replace(duration, 'minute|mins| ', '', 'g'))"),           # PR-C8
    ("duration", "trim(regexp_replace(duration, 's', '', 'g'))"),                       # PR-C9
]


def steps_sql(source: str, steps) -> str:
    """Nest ``select * replace (...)`` once per step over ``source``."""
    q = f"select * from {source}"
    for col, expr in steps:
        q = f"select * replace ({expr} as {col}) from ({q})"
    return q


DELIVERY_SQL["pr_customer_orders"] = steps_sql("pr_customer_orders_raw", CUSTOMER_ORDER_STEPS_SQL)
DELIVERY_SQL["pr_runner_orders"] = steps_sql("pr_runner_orders_raw", RUNNER_ORDER_STEPS_SQL)


# --------------------------------------------------------------------------
# Subscriptions: subscriptions (customer_id, plan_id, start_date),
#                plans (plan_id, plan_name, price)
# --------------------------------------------------------------------------

# The study's plan catalogue (id, name, monthly price; churn has none).
PLAN_CATALOGUE = [
    (0, "trial", "0.00"),
    (1, "basic monthly", "9.90"),
    (2, "pro monthly", "19.90"),
    (3, "pro annual", "199.00"),
    (4, "churn", None),
]


def _plan_case(key: str, value_idx: int, cast: str | None = None) -> F.Column:
    out = None
    for row in PLAN_CATALOGUE:
        v = F.lit(row[value_idx])
        if cast:
            v = v.cast(cast)
        out = (F.when if out is None else out.when)(F.col(key) == row[0], v)
    return out


def subscriptions(t: Tables) -> LazyViews:
    def subs():
        return t.orders.select(
            F.col("o_custkey").alias("customer_id"),
            (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("plan_id"),
            _date("o_orderdate").alias("start_date"),
        )

    def plans():
        # one row per plan of the catalogue (and NULL): small by its key domain
        return F.broadcast(v.subscriptions.select("plan_id").distinct().select(
            "plan_id",
            _plan_case("plan_id", 1).alias("plan_name"),
            _plan_case("plan_id", 2, "decimal(5,2)").alias("price"),
        ))
    v = LazyViews(subscriptions=subs, plans=plans)
    return v


def _plan_sql(idx: int, cast: str | None = None) -> str:
    parts = []
    for row in PLAN_CATALOGUE:
        v = "NULL" if row[idx] is None else f"'{row[idx]}'"
        if cast:
            v = f"cast({v} as {cast})"
        parts.append(f"when {row[0]} then {v}")
    return "case plan_id " + " ".join(parts) + " end"


SUBSCRIPTIONS_SQL = {
    "ff_subscriptions": """
        select o_custkey as customer_id,
               cast(substr(o_orderpriority, 1, 1) as integer) - 1 as plan_id,
               cast(o_orderdate as date) as start_date
        from orders""",
    "ff_plans": f"""
        select plan_id, {_plan_sql(1)} as plan_name, {_plan_sql(2, 'decimal(5,2)')} as price
        from (select distinct plan_id from ff_subscriptions)""",
}


# --------------------------------------------------------------------------
# Bank: regions, customer_nodes, customer_transactions
# --------------------------------------------------------------------------

def bank(t: Tables) -> LazyViews:
    return LazyViews(
        regions=lambda: t.region.select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name")),
        customer_nodes=lambda: _bank_nodes(t),
        node_spans=lambda: _bank_nodes(t, ends=False),
        customer_transactions=lambda: _bank_transactions(t))


def _bank_nodes(t: Tables, ends: bool = True) -> DataFrame:
    cust_region = _lookup(
        t.customer.select("c_custkey", "c_nationkey").join(
            t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey"),
        "c_custkey", ["n_regionkey"], "customer_id")
    spans = t.orders.select(
        F.col("o_custkey").alias("customer_id"),
        ((F.col("o_orderkey") % 5) + 1).cast("int").alias("node_id"),
        _date("o_orderdate").alias("start_date"),
        "o_orderkey",
    )
    # a node allocation ends where the customer's next one starts (open end:
    # sentinel); the region is looked up afterwards, and only if used
    if ends:
        spans = neighbor(spans, ["customer_id"], ["start_date", "o_orderkey"], "start_date", "end_date", "next").withColumn(
            "end_date", F.coalesce(F.col("end_date"), F.lit(OPEN_END)))
    return spans.join(cust_region, "customer_id", "left").select(
        "customer_id", F.col("n_regionkey").alias("region_id"), "node_id", "start_date", *["end_date"] * ends)


def _bank_transactions(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("customer_id"),
        _date("o_orderdate").alias("txn_date"),
        F.when(F.col("o_orderstatus") == "F", "deposit")
        .when(F.col("o_orderstatus") == "O", "purchase")
        .when(F.col("o_orderstatus") == "P", "withdrawal").alias("txn_type"),
        money("o_totalprice").alias("txn_amount"),
    )


BANK_SQL = {
    "db_regions": "select r_regionkey as region_id, r_name as region_name from region",
    "db_customer_nodes": """
        select o.o_custkey as customer_id, n.n_regionkey as region_id,
               cast(o.o_orderkey % 5 + 1 as integer) as node_id,
               cast(o.o_orderdate as date) as start_date,
               coalesce(lead(cast(o.o_orderdate as date)) over
                        (partition by o.o_custkey order by cast(o.o_orderdate as date), o.o_orderkey),
                        date '9999-12-31') as end_date
        from orders o left join (select c.c_custkey, max(n.n_regionkey) as n_regionkey
                                 from customer c join nation n on c.c_nationkey = n.n_nationkey
                                 group by c.c_custkey) n on o.o_custkey = n.c_custkey""",
    "db_customer_transactions": """
        select o_custkey as customer_id, cast(o_orderdate as date) as txn_date,
               case o_orderstatus when 'F' then 'deposit' when 'O' then 'purchase'
                                  when 'P' then 'withdrawal' end as txn_type,
               cast(o_totalprice as decimal(12,2)) as txn_amount
        from orders""",
}


# --------------------------------------------------------------------------
# Weekly mart: weekly_sales (week_date as d/M/yyyy text, region, platform,
#              segment, customer_type, transactions, sales)
# --------------------------------------------------------------------------

def mart(t: Tables) -> LazyViews:
    return LazyViews(
        weekly_sales_raw=lambda: _mart_weekly(t),
        # the weeks from one day to another, by a range on the orders' date
        weekly_between=lambda: lambda first, last: _mart_weekly(t, days_of_weeks(first, last)))


def _mart_weekly(t: Tables, days: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    cust = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    geo = t.nation.select("n_nationkey", "n_regionkey").join(
        t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey")
    letter = (F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), F.lit("C"))
              .when(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"), F.lit("F")))
    segment = F.when(letter.isNull(), F.lit("null")).otherwise(
        F.concat(letter, ((F.col("c_nationkey") % 4) + 1).cast("string")))
    orders = t.orders
    if days is not None:
        kind = orders.schema["o_orderdate"].dataType
        orders = orders.where((F.col("o_orderdate") >= F.lit(days[0]).cast(kind)) & (F.col("o_orderdate") < F.lit(days[1]).cast(kind)))
    rows = (
        orders.select("o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.date_trunc("week", F.col("o_orderdate")).cast("date").alias("week"),
            F.col("r_name").alias("region"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("Retail"))
            .otherwise(F.lit("Shopify")).alias("platform"),
            segment.alias("segment"),
            F.when(F.col("o_orderstatus") == "F", F.lit("Existing"))
            .when(F.col("o_orderstatus") == "O", F.lit("New")).otherwise(F.lit("Guest")).alias("customer_type"),
            money("o_totalprice").alias("amount"),
        )
    )
    return (
        rows.groupBy("week", "region", "platform", "segment", "customer_type")
        .agg(F.count(F.lit(1)).alias("transactions"), F.sum("amount").cast(TOTAL).alias("sales"))
        .select(F.date_format("week", "d/M/yyyy").alias("week_date"),
                "region", "platform", "segment", "customer_type", "transactions", "sales")
    )


MART_SQL = {
    "dm_weekly_sales_raw": """
        select strftime(week, '%-d/%-m/%Y') as week_date, region, platform, segment, customer_type,
               count(*) as transactions, cast(sum(amount) as decimal(38,2)) as sales
        from (
          select cast(date_trunc('week', o.o_orderdate) as date) as week, r.r_name as region,
                 case when o.o_orderpriority in ('1-URGENT', '2-HIGH') then 'Retail' else 'Shopify' end as platform,
                 case when c.c_mktsegment in ('AUTOMOBILE', 'BUILDING') then 'C' || cast(c.c_nationkey % 4 + 1 as varchar)
                      when c.c_mktsegment in ('FURNITURE', 'HOUSEHOLD') then 'F' || cast(c.c_nationkey % 4 + 1 as varchar)
                      else 'null' end as segment,
                 case o.o_orderstatus when 'F' then 'Existing' when 'O' then 'New' else 'Guest' end as customer_type,
                 cast(o.o_totalprice as decimal(12,2)) as amount
          from orders o join customer c on o.o_custkey = c.c_custkey
               join nation n on c.c_nationkey = n.n_nationkey
               join region r on n.n_regionkey = r.r_regionkey)
        group by week, region, platform, segment, customer_type""",
}


# --------------------------------------------------------------------------
# Funnel: events (visit_id, cookie_id, page_id, event_type, sequence_number,
#         event_time), users, page_hierarchy, campaign_identifier
# --------------------------------------------------------------------------

# The funnel study's event codes, 1 page view, 2 cart add,
# 3 purchase, 4 ad impression, 5 ad click; the driver's event names map onto
# them in this order.
EVENT_CODES = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}
N_PAGES = 13          # 1, 2 landing pages; 3..11 product pages; 12 checkout; 13 confirmation
CHECKOUT_PAGE = 12

# Campaign calendar over the driver's event month: an overlap (A/B) and a gap (B/C).
CAMPAIGNS = [
    ("Campaign A", dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 10, 23, 59, 59)),
    ("Campaign B", dt.datetime(2024, 1, 8, 0, 0, 0), dt.datetime(2024, 1, 17, 23, 59, 59)),
    ("Campaign C", dt.datetime(2024, 1, 22, 0, 0, 0), dt.datetime(2024, 1, 31, 23, 59, 59)),
]


def funnel(t: Tables) -> LazyViews:
    v = LazyViews(
        _events_u=lambda: _funnel_events(t),
        events=lambda: v._events_u.drop("user_id"),
        users=lambda: v._events_u.select("user_id", "cookie_id").distinct(),
        page_hierarchy=lambda: _page_hierarchy(v.events),
        campaign_identifier=lambda: t.spark.createDataFrame(
            CAMPAIGNS, "campaign_name string, start_date timestamp_ntz, end_date timestamp_ntz"),
    )
    return v


def _funnel_events(t: Tables) -> DataFrame:
    et = None
    for name, code in EVENT_CODES.items():
        et = (F.when if et is None else et.when)(F.col("event_type") == name, F.lit(code))
    return t.events.select(
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("ts").cast("date").cast("string")).alias("visit_id"),
        (F.col("user_id") * 10 + F.dayofmonth("ts") % 3).alias("cookie_id"),
        ((F.get_json_object("props", "$.k").cast("int") % N_PAGES) + 1).alias("page_id"),
        et.alias("event_type"),
        F.col("event_id").alias("sequence_number"),
        F.col("ts").alias("event_time"),
        "user_id",
    )


def _page_hierarchy(events: DataFrame) -> DataFrame:
    is_product = F.col("page_id").between(3, 11)
    # at most N_PAGES rows (and NULL), by the key's modulus
    return F.broadcast(events.select("page_id").distinct().select(
        "page_id",
        F.when(is_product, F.concat(F.lit("group_"), (int_div(F.col("page_id") - 3, F.lit(3)) + 1).cast("string")))
        .alias("product_category"),
        F.when(is_product, F.col("page_id") - 2).alias("product_id"),
    ))


def _campaign_values() -> str:
    rows = ", ".join(
        f"('{n}', timestamp '{s:%Y-%m-%d %H:%M:%S}', timestamp '{e:%Y-%m-%d %H:%M:%S}')"
        for n, s, e in CAMPAIGNS)
    return f"select * from (values {rows}) as c(campaign_name, start_date, end_date)"


FUNNEL_SQL = {
    "cb_events_u": f"""
        select cast(user_id as varchar) || '-' || cast(cast(ts as date) as varchar) as visit_id,
               user_id * 10 + day(ts) % 3 as cookie_id,
               cast(json_extract_string(props, '$.k') as integer) % {N_PAGES} + 1 as page_id,
               case event_type {' '.join(f"when '{k}' then {v}" for k, v in EVENT_CODES.items())} end as event_type,
               event_id as sequence_number, ts as event_time, user_id
        from events""",
    "cb_events": """
        select visit_id, cookie_id, page_id, event_type, sequence_number, event_time from cb_events_u""",
    "cb_users": "select distinct user_id, cookie_id from cb_events_u",
    "cb_page_hierarchy": """
        select page_id,
               case when page_id between 3 and 11 then 'group_' || cast((page_id - 3) // 3 + 1 as varchar) end
                 as product_category,
               case when page_id between 3 and 11 then page_id - 2 end as product_id
        from (select distinct page_id from cb_events)""",
    "cb_campaign_identifier": _campaign_values(),
}


def with_views(views: dict[str, str], body: str) -> str:
    """Prefix ``body`` with the views as CTEs (DuckDB inlines unused ones away)."""
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in views.items())
    return f"WITH {ctes}\n{body}"


def resolve(spark, source, builder) -> LazyViews:
    """Study tables from ``source``: a driver-table folder (built with
    ``builder``) or a namespace already holding the study's DataFrames
    (e.g. the user's own tables, or test fixtures), copied shallowly."""
    if isinstance(source, str):
        from casebook.sources.tables import load
        return builder(load(spark, source))
    if isinstance(source, LazyViews):
        return source.copy()
    return LazyViews(**{k: (lambda v=v: v) for k, v in vars(source).items()})
