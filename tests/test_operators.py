"""Operator properties against brute force on small random inputs, including
a hot key / hot group holding a large share of the rows."""

import datetime as dt
import itertools
import random
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
import pytest

from casebook.functions.clean import week_from_jan1, week_mode0
from casebook.operators.basket import most_common_triple, triple_counts
from casebook.operators.logistics import RUNNER_ORDER_STEPS, apply_steps
from casebook.operators.quantile import ordinal_pick, rank_ceil, rank_floor
from casebook.operators.rank import all_firsts_per, first_per
from casebook.operators.sequence import neighbor
from tests import fixtures


def _skewed_rows(seed, n=3000, groups=6):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        g = 0 if rnd.random() < 0.4 else rnd.randrange(1, groups)       # group 0 is hot
        v = rnd.choice([7, 7, 7, 7]) if rnd.random() < 0.3 else rnd.randrange(0, 500)  # value 7 is hot
        out.append((g, v, i))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_ordinal_pick_matches_sorting(spark, seed):
    rows = _skewed_rows(seed)
    df = spark.createDataFrame(rows, "g int, v int, i int")
    picks = {"p25": rank_floor(25, 100), "p50": rank_floor(1, 2), "p95": rank_ceil(95, 100), "p0": rank_floor(0, 1)}
    got = {r["g"]: (r["p25"], r["p50"], r["p95"], r["p0"])
           for r in ordinal_pick(df, "v", picks, by=["g"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v", "i"])
    for g, part in pdf.groupby("g"):
        s = sorted(part["v"])
        n = len(s)

        def at(r):
            return s[r - 1] if 1 <= r <= n else None
        assert got[g] == (at(n * 25 // 100), at(n // 2), at(-(-n * 95 // 100)), None)


def test_ordinal_pick_single_group(spark):
    rows = [(v,) for v in [5] * 50 + list(range(100))]
    df = spark.createDataFrame(rows, "v int")
    r = ordinal_pick(df, "v", {"a": rank_floor(1, 2), "b": rank_ceil(75, 100)}).first()
    s = sorted(x[0] for x in rows)
    assert (r["a"], r["b"]) == (s[len(s) // 2 - 1], s[-(-len(s) * 75 // 100) - 1])


def test_neighbor_matches_pandas_shift(spark):
    rnd = random.Random(3)
    rows = [(0 if rnd.random() < 0.5 else rnd.randrange(1, 20), i, rnd.randrange(100)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    nxt = {(r["k"], r["t"]): r["nv"] for r in neighbor(df, ["k"], ["t"], "v", "nv", "next", chunk=F.floor(F.col("t") / 50)).collect()}
    prv = {(r["k"], r["t"]): r["pv"] for r in neighbor(df, ["k"], ["t"], "v", "pv", "prev", chunk=F.floor(F.col("t") / 50)).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "t", "v"]).sort_values(["k", "t"])
    pdf["nv"] = pdf.groupby("k")["v"].shift(-1)
    pdf["pv"] = pdf.groupby("k")["v"].shift(1)
    for r in pdf.itertuples():
        assert nxt[(r.k, r.t)] == (None if pd.isna(r.nv) else int(r.nv))
        assert prv[(r.k, r.t)] == (None if pd.isna(r.pv) else int(r.pv))


def test_first_per_and_ties(spark):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 5, "q")]
    df = spark.createDataFrame(rows, "k string, o int, p string")
    assert sorted(tuple(r) for r in first_per(df, ["k"], ["o"]).collect()) == [("a", 1, "x"), ("b", 5, "q")]
    assert sorted(tuple(r) for r in first_per(df, ["k"], ["o"], descending=True).collect()) == [
        ("a", 2, "z"), ("b", 5, "q")]
    assert sorted(r["p"] for r in all_firsts_per(df, ["k"], "o").collect()) == ["q", "x", "y"]


def _brute_triples(baskets):
    c = Counter()
    for items in baskets.values():
        for t in itertools.combinations(sorted(set(items)), 3):
            c[t] += 1
    return c


def test_triples_match_brute_force(spark):
    rnd = random.Random(5)
    names = [f"p{i:02d}" for i in range(40)]
    baskets = {b: rnd.sample(names[:12] if b % 3 == 0 else names, rnd.randrange(1, 8)) for b in range(400)}
    baskets[999] = names[:25]                                # one very large basket
    rows = [(b, it) for b, items in baskets.items() for it in items]
    df = spark.createDataFrame(rows, "b int, item string")
    brute = _brute_triples(baskets)
    best = max(brute.values())
    top = sorted(t for t, n in brute.items() if n == best)[0]
    r = most_common_triple(df, "b", "item").first()
    assert (r["product_1"], r["product_2"], r["product_3"], r["combo_count"]) == (*top, best)
    third = sorted(brute.values(), reverse=True)[2]
    got = {(r["i1"], r["i2"], r["i3"]): r["combo_count"] for r in triple_counts(df, "b", "item", k=3).collect()}
    for t, n in got.items():
        assert brute[t] == n                                 # every reported count is exact
    assert all(t in got for t, n in brute.items() if n >= third)


def test_cleaning_is_idempotent(spark):
    raw = fixtures.delivery(spark).runner_orders_raw
    once = apply_steps(raw, RUNNER_ORDER_STEPS)
    twice = apply_steps(once, RUNNER_ORDER_STEPS)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_week_numbers_match_strftime(spark):
    days = [dt.date(1995, 1, 1) + dt.timedelta(days=i) for i in range(0, 365 * 36, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d", week_mode0("d").alias("w0"), week_from_jan1("d").alias("w1"))
    for r in df.collect():
        assert r["w0"] == int(r["d"].strftime("%U"))
        assert r["w1"] == (r["d"].timetuple().tm_yday + 6) // 7


def test_month_end_balance_equals_signed_total(spark):
    from casebook.operators.ledger import month_end_balances
    rows = [(1, dt.date(2020, 1, 5), "deposit", 100), (1, dt.date(2020, 3, 2), "purchase", 30),
            (2, dt.date(2020, 2, 1), "withdrawal", 10), (2, dt.date(2020, 2, 9), "deposit", 50)]
    t = spark.createDataFrame(rows, "customer_id int, txn_date date, txn_type string, txn_amount int")
    b = {(r["customer_id"], r["month"]): r["closing_balance"] for r in month_end_balances(t).collect()}
    assert b == {(1, dt.date(2020, 1, 1)): 100, (1, dt.date(2020, 2, 1)): 100, (1, dt.date(2020, 3, 1)): 70,
                 (2, dt.date(2020, 2, 1)): 40, (2, dt.date(2020, 3, 1)): 40}


def test_no_python_udf_in_plans(spark):
    import __spark_entry__ as se
    for qid in ("bt_16", "cb_13", "db_10", "dm_c11", "pr_c9"):
        plan = se.queries()[qid](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_filters_and_columns_pushed_to_scan(spark):
    import __spark_entry__ as se
    plan = se.queries()["ff_08"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
    assert "LessThan(o_orderdate,1998-01-01T00:00)" in plan   # date cut-off reaches the parquet scan


def test_running_total_matches_cumsum(spark):
    from casebook.operators.sequence import running_total
    rnd = random.Random(11)
    rows = [(0 if rnd.random() < 0.5 else rnd.randrange(1, 15), i, rnd.randrange(-5, 10)) for i in range(1500)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    got = {(r["k"], r["t"]): r["s"] for r in running_total(df, ["k"], ["t"], "v", "s", chunk=F.floor(F.col("t") / 50)).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "t", "v"]).sort_values(["k", "t"])
    pdf["s"] = pdf.groupby("k")["v"].cumsum()
    assert all(got[(r.k, r.t)] == r.s for r in pdf.itertuples())


def test_ff_11_counts_the_pairs(spark):
    import duckdb

    import __spark_entry__ as se
    from tests.conftest import SMALL
    got = sum(r["earlier_pro_monthly_rows"] for r in se.queries()["ff_11"](spark, SMALL).collect())
    pairs = duckdb.sql(f"""
        with s as (select o_custkey c, cast(substr(o_orderpriority, 1, 1) as int) - 1 p, cast(o_orderdate as date) d
                   from '{SMALL}/orders.parquet' where o_orderdate < date '1998-01-01')
        select count(*) from s a join s b on a.c = b.c and a.p = 2 and b.p = 1 and a.d < b.d""").fetchall()[0][0]
    assert got == pairs


def test_inspect_helpers(spark):
    from casebook.operators.inspect import describe, preview, register_views, update
    dn = fixtures.diner(spark)
    assert [r["col_name"] for r in describe(dn.sales).collect()] == ["customer_id", "order_date", "product_id"]
    assert [tuple(r) for r in preview(dn.menu, 2, ["price"]).collect()] == [(1, "sushi", 10), (3, "ramen", 12)]
    register_views(spark, dn, ["sales", "menu", "members"], prefix="dn_fixture_")
    got = dict(spark.sql("select s.customer_id, sum(m.price) from dn_fixture_sales s join dn_fixture_menu m "
                         "on s.product_id = m.product_id group by s.customer_id").collect())
    assert got == {"A": 76, "B": 74, "C": 36}
    u = update(dn.menu, "price", F.col("price") * 2, F.col("product_name") == "sushi")
    assert sorted(r["price"] for r in u.collect()) == [12, 15, 20]


def test_campaign_join_equals_the_range_join(spark):
    import __spark_entry__ as se
    from casebook.operators.funnel import attach_campaign
    from casebook.plans import funnel
    v = funnel.views(spark, "/root/testdata/sf0.001")
    base = se.queries()["cb_13_intended"](spark, "/root/testdata/sf0.001").drop("campaign_name").withColumn(
        "visit_start_time", F.col("visit_start_time").cast("timestamp_ntz"))
    inside = F.col("visit_start_time").between(F.col("start_date"), F.col("end_date"))
    ranged = base.join(v.campaign_identifier, inside, "left").drop("start_date", "end_date")
    keyed = attach_campaign(base, v.campaign_identifier, "left")
    assert sorted(map(repr, keyed.collect())) == sorted(map(repr, ranged.collect()))


def test_payment_schedule_has_no_length_limit(spark):
    from casebook.operators.lifecycle import payment_schedule
    log = spark.createDataFrame([(1, 1, dt.date(2020, 1, 1))], "customer_id int, plan_id int, start_date date")
    plans = spark.createDataFrame([(1, "basic", 10)], "plan_id int, plan_name string, price int")
    for years in (1, 2, 3):
        paid = payment_schedule(log, plans, dt.date(2020, 1, 1), dt.date(2020 + years, 1, 1), monthly=(1,), annual=(),
                                upgrade_from=0, upgrade_credit=F.lit(0))
        assert paid.count() == 12 * years


def test_neighbor_across_months_by_default(spark):
    rows = [(1, dt.date(2020, 1, 1) + dt.timedelta(days=17 * i), i) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, t date, v int")
    got = {r["v"]: r["nv"] for r in neighbor(df, ["k"], ["t"], "v", "nv").collect()}
    assert got == {i: i + 1 if i < 59 else None for i in range(60)}


def test_value_chunk_keeps_the_order(spark):
    from casebook.operators.quantile import value_chunk
    vals = [-1e300, -5.0, -1.0, -1e-300, 0.0, 1e-300, 0.5, 1.0, 1.001, 2.0, 1e9, 1e300]
    df = spark.createDataFrame([(v,) for v in vals], "v double").orderBy("v").select(value_chunk(F.col("v")).alias("c"))
    chunks = [r["c"] for r in df.collect()]
    assert chunks == sorted(chunks)


def test_week_text_with_two_or_four_digit_years(spark):
    from casebook.plans.mart import week_date
    df = spark.createDataFrame([("31/8/20",), ("31/8/2020",), ("x",), (None,)], "d string")
    assert [r[0] for r in df.select(week_date(F.col("d"))).collect()] == [dt.date(2020, 8, 31)] * 2 + [None] * 2


def test_chunked_operators_with_a_single_key(spark):
    from casebook.operators.sequence import running_total
    rows = [(1, i, i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    nxt = {r["t"]: r["nv"] for r in neighbor(df, ["k"], ["t"], "v", "nv", "next", chunk=F.floor(F.col("t") / 50)).collect()}
    assert all(nxt[i] == (i + 1) % 7 for i in range(499)) and nxt[499] is None
    run = {r["t"]: r["s"] for r in running_total(df, ["k"], ["t"], "v", "s", chunk=F.floor(F.col("t") / 50)).collect()}
    assert run[499] == sum(i % 7 for i in range(500))
    same = spark.createDataFrame([(3,)] * 200, "v int")
    r = ordinal_pick(same, "v", {"m": rank_floor(1, 2)}).first()
    assert r["m"] == 3


def test_neighbors_both_directions_in_one_pass(spark):
    from casebook.operators.sequence import neighbors
    rnd = random.Random(13)
    rows = [(0 if rnd.random() < 0.5 else rnd.randrange(1, 9), i, rnd.randrange(50)) for i in range(1200)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    got = {(r["k"], r["t"]): (r["n"], r["p"])
           for r in neighbors(df, ["k"], ["t"], "v", next_out="n", prev_out="p", chunk=F.floor(F.col("t") / 50)).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "t", "v"]).sort_values(["k", "t"])
    pdf["n"] = pdf.groupby("k")["v"].shift(-1)
    pdf["p"] = pdf.groupby("k")["v"].shift(1)
    for r in pdf.itertuples():
        assert got[(r.k, r.t)] == (None if pd.isna(r.n) else int(r.n), None if pd.isna(r.p) else int(r.p))


def test_missing_numbers_ignores_nulls(spark):
    from casebook.operators.period import missing_numbers
    present = spark.createDataFrame([(1,), (2,), (4,), (None,)], "w int")
    bound = spark.createDataFrame([(5,)], "n int")
    assert sorted(r["rn"] for r in missing_numbers(present, "w", bound).collect()) == [3, 5]
    empty_bound = spark.createDataFrame([(0,)], "n int")
    assert missing_numbers(present, "w", empty_bound).count() == 0


def test_before_after_windows(spark):
    from decimal import Decimal

    from casebook.operators.period import around_date, around_date_as_written
    d = dt.date(2020, 6, 15)
    rows = [(d - dt.timedelta(days=7 * i), Decimal(10 * i + 1)) for i in range(-5, 6)]
    df = spark.createDataFrame(rows, "week_date date, sales decimal(18,2)")
    w = around_date_as_written(df, "week_date", "sales", d, 2).first()
    # closed ranges: the baseline week (sales 1) is in both
    assert (w["prev_weeks_sales"], w["after_weeks_sales"]) == (1 + 11 + 21, 1 - 9 - 19)
    # half-open ranges: [b - 2 weeks, b) and [b, b + 2 weeks)
    h = around_date(df, "week_date", "sales", d, 2).first()
    assert (h["before_sales"], h["after_sales"], h["sales_change"]) == (11 + 21, 1 - 9, (1 - 9) - (11 + 21))


def test_chunked_operators_keep_a_null_key(spark):
    from casebook.operators.sequence import running_total
    rows = [(None, i, i) for i in range(40)] + [(1, i, 1) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    nxt = {(r["k"], r["t"]): r["nv"] for r in neighbor(df, ["k"], ["t"], "v", "nv", "next", chunk=F.floor(F.col("t") / 50)).collect()}
    assert all(nxt[(None, i)] == i + 1 for i in range(39)) and nxt[(None, 39)] is None
    run = {(r["k"], r["t"]): r["s"] for r in running_total(df, ["k"], ["t"], "v", "s", chunk=F.floor(F.col("t") / 50)).collect()}
    assert run[(None, 39)] == sum(range(40)) and run[(1, 39)] == 40
    g = spark.createDataFrame([(None, v) for v in range(10)] + [("a", v) for v in range(5)], "g string, v int")
    got = {r["g"]: r["m"] for r in ordinal_pick(g, "v", {"m": rank_floor(1, 2)}, by=["g"]).collect()}
    assert got == {None: 4, "a": 1}


def test_ordinal_pick_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.tuples(st.integers(0, 3), st.integers(-20, 20)), min_size=1, max_size=60),
           st.integers(1, 99))
    def check(rows, pct):
        df = spark.createDataFrame(rows, "g int, v int")
        got = {r["g"]: r["q"] for r in ordinal_pick(df, "v", {"q": rank_ceil(pct, 100)}, by=["g"]).collect()}
        for g in {r[0] for r in rows}:
            s = sorted(v for k, v in rows if k == g)
            r = -(-len(s) * pct // 100)
            assert got[g] == (s[r - 1] if 1 <= r <= len(s) else None)
    check()
