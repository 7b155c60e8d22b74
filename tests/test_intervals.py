"""Interval covers and joins against brute force; pruned date windows."""

import datetime as dt
import random
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from casebook.operators import intervals as I
from casebook.operators.period import day_texts, days_of_weeks
from casebook.plans import QUERIES, mart
from tests.conftest import SMALL

EPOCH = dt.date(1970, 1, 1)


def test_cover_is_exact_and_logarithmic(spark):
    rnd = random.Random(2)
    pairs = [(rnd.randint(-3000, 3000), rnd.randint(0, 5000)) for _ in range(200)] + [(-5, 0), (0, 0), (31, 1), (32, 31), (1024, 1023), (-1, 2)]
    rows = [(i, EPOCH + dt.timedelta(days=a), EPOCH + dt.timedelta(days=a + n)) for i, (a, n) in enumerate(pairs)]
    rows += [(1000, dt.date(2024, 1, 1), dt.date(9999, 12, 31)), (1001, dt.date(1, 1, 1), dt.date(9999, 12, 31)), (1002, dt.date(2024, 2, 1), dt.date(2024, 1, 1)),
             (1003, None, dt.date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "i int, a date, b date")
    got = {r.i: r.c for r in df.select("i", I.cover(F.col("a"), F.col("b")).alias("c")).collect()}
    for i, (a, n) in enumerate(pairs):
        days = [d for c in got[i] for d in range(c.cell * 32 ** c.level, (c.cell + 1) * 32 ** c.level)]
        assert sorted(days) == list(range(a, a + n + 1))
        assert len(got[i]) <= 62 * I.LEVELS
    for i in (1000, 1001):
        assert len(got[i]) < 150 and sum(32 ** c.level for c in got[i]) == (rows[206 + i - 1000][2] - rows[206 + i - 1000][1]).days + 1
    assert not got[1002] and not got[1003]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_by_brute_force(spark, how):
    rnd = random.Random(3)

    def when():
        return dt.datetime(2023, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 700), minutes=rnd.randint(0, 59))
    points = [(i, when()) for i in range(300)] + [(300, None), (301, dt.datetime(9999, 12, 31, 1)), (5, when()), (302, dt.datetime(1900, 1, 1))]
    spans = [(f"s{i}", a, a + dt.timedelta(hours=rnd.choice([0, 5, 30, 900, 9000]))) for i, a in enumerate(when() for _ in range(40))]
    spans += [("open", dt.datetime(2023, 6, 1), dt.datetime(9999, 12, 31, 23)), ("none", None, when()), ("back", dt.datetime(2024, 1, 1), dt.datetime(2023, 1, 1)),
              ("s1", *spans[1][1:])]
    p = spark.createDataFrame(points, "i int, at timestamp_ntz")
    s = spark.createDataFrame(spans, "name string, since timestamp_ntz, until timestamp_ntz")
    got = Counter((r.i, r["at"], r.name) for r in I.interval_join(p, s, "at", "since", "until", how).collect())
    want = Counter()
    for i, at in points:
        hits = [n for n, a, b in spans if at and a and b and a <= at <= b]
        want.update((i, at, n) for n in hits or ([None] if how == "left" else []))
    assert got == want
    assert I.interval_join(p, s.limit(0), "at", "since", "until", how).count() == (len(points) if how == "left" else 0)
    with pytest.raises(ValueError):
        I.interval_join(p, s, "at", "since", "until", "full")


def test_week_range_inversion():
    def week(d):
        return d - dt.timedelta(days=d.weekday())
    rnd = random.Random(4)
    for _ in range(200):
        a = dt.date(1998, 1, 1) + dt.timedelta(days=rnd.randint(0, 60))
        b = a + dt.timedelta(days=rnd.randint(-3, 40))
        first, end = days_of_weeks(a, b)
        for n in range(-10, 120):
            d = dt.date(1998, 1, 1) + dt.timedelta(days=n)
            assert (first <= d < end) == (a <= week(d) <= b)


def test_text_dates_are_all_listed(spark):
    texts = day_texts(dt.date(2004, 8, 9), dt.date(2004, 10, 11))
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(mart.week_date(F.col("t")).alias("d"))
    assert df.where("d is null or d < '2004-08-09' or d > '2004-10-11'").count() == 0
    assert {"9/8/2004", "09/08/04", "9/08/2004", "11/10/04"} <= set(texts) and "8/8/2004" not in texts


@pytest.mark.parametrize("qid", ["dm_10", "dm_11", "dm_10_intended", "dm_11_intended"])
def test_date_windows_reach_the_scan(spark, qid, tmp_path):
    """The range is pushed down, row groups outside it are skipped, and the
    answer is that of the whole table."""
    plan = QUERIES[qid](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "o_orderdate" in x and "FileScan" in x)
    pushed = scan[scan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.read.parquet(f"{SMALL}/orders.parquet").coalesce(1).sortWithinPartitions("o_orderdate").write.option(
        "parquet.block.size", 2048).option("parquet.page.size", 1024).option("parquet.block.size.row.check.min", 10).option(
        "parquet.page.size.row.check.min", 10).parquet(str(tmp_path / "orders.parquet"))
    df = QUERIES[qid](spark, str(tmp_path))
    assert df.collect() == QUERIES[qid](spark, SMALL).collect()
    whole = SimpleNamespace(weekly_sales_raw=mart.studies.resolve(spark, SMALL, mart.studies.mart).weekly_sales_raw)
    assert QUERIES[qid](spark, whole).collect() == df.collect()


def test_cart_of_a_hot_visit_is_built_from_pieces(spark, monkeypatch):
    """One visit with a third of all cart adds: no list beyond a block of the
    sequence, and the same text as one ordered list."""
    from casebook.operators import funnel
    monkeypatch.setattr(funnel, "_BLOCK_BITS", 8)
    rnd = random.Random(6)
    rows = [("bot" if n % 3 == 0 else f"v{rnd.randint(0, 400)}", rnd.randint(1, 13), rnd.choice([1, 2, 2, 2, 3]), n) for n in range(9000)]
    rnd.shuffle(rows)
    events = spark.createDataFrame([(v, 1, p, e, s, dt.datetime(2024, 1, 1)) for v, p, e, s in rows],
                                   "visit_id string, cookie_id int, page_id int, event_type int, sequence_number int, event_time timestamp_ntz")
    users = spark.createDataFrame([(1, 1)], "cookie_id int, user_id int")
    pages = spark.createDataFrame([(p, p - 2 if 3 <= p <= 11 else None) for p in range(1, 14)], "page_id int, product_id int")
    got = {r.visit_id: (r.cart_products, r.page_views, r.cart_adds, r.purchase) for r in funnel.visit_summary(events, users, pages).collect()}
    for v in {r[0] for r in rows}:
        mine = sorted((s, p, e) for w, p, e, s in rows if w == v)
        cart = [str(p - 2) for _, p, e in mine if e == 2 and 3 <= p <= 11]
        assert got[v] == (",".join(cart) if cart else None, len(mine), sum(e == 2 for *_, e in mine), int(any(e == 3 for *_, e in mine)))
    plan = funnel.visit_summary(events, users, pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") >= 2 and "_block" in plan
