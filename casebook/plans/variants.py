"""Steps and comparisons of the studies that the driver's clean tables leave
without effect, on tables that show it: text in mixed case, week dates in
several spellings, declared text lengths, years with missing weeks, previews
and schema listings.

The mixed and messy tables are derived from the study views by fixed rules,
row by row, in Spark and in SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions.clean import flag_to_int, label_by_prefix, label_by_suffix
from casebook.functions.collation import ci, collated, group_key
from casebook.functions.varchar import as_varchar, widen, widths
from casebook.operators.basket import most_common_triple
from casebook.operators.inspect import describe, preview
from casebook.plans import mart, retail
from casebook.plans.registry import register
from casebook.sources import studies

# ---- text in mixed case ------------------------------------------------------

_MIXED_MART = {**studies.MART_SQL, "mixed": """
    select * replace (case when length(region) % 2 = 1 then lower(segment) else segment end as segment)
    from dm_weekly_sales_raw"""}
_MIXED_RETAIL = {**studies.RETAIL_SQL, "mixed_sales": """
    select * replace (case when txn_id % 2 = 1 then upper(member) else member end as member) from bt_sales_raw""",
                 "mixed_products": """
    select * replace (case when product_id % 2 = 1 then upper(product_name) else product_name end as product_name)
    from bt_product_details"""}


def mixed_mart(spark, sf) -> DataFrame:
    raw = studies.resolve(spark, sf, studies.mart).weekly_sales_raw
    return raw.withColumn("segment", F.when(F.length("region") % 2 == 1, F.lower("segment")).otherwise(F.col("segment")))


def mixed_sales(v) -> DataFrame:
    return v.sales_raw.withColumn("member", F.when(F.col("txn_id") % 2 == 1, F.upper("member")).otherwise(F.col("member")))


def mixed_products(v) -> DataFrame:
    return v.product_details.withColumn(
        "product_name", F.when(F.col("product_id") % 2 == 1, F.upper("product_name")).otherwise(F.col("product_name")))


_AGE_CI = ("case when segment collate nocase = 'NULL' then null "
           + " ".join(f"when segment ilike '%{k}' then '{v}'" for k, v in mart.AGE_BANDS.items()) + f" else '{mart.AGE_BAND_OTHER}' end")
_DEMO_CI = "case " + " ".join(f"when segment ilike '{k}%' then '{v}'" for k, v in mart.DEMOGRAPHICS.items()) + " end"


@register("dm_c7_ci", studies.with_views(_MIXED_MART, f"""
    select segment, {_AGE_CI} as age_brand, {_DEMO_CI} as demographic, count(*) as n
    from mixed group by all"""))
def dm_c7_ci(spark, sf):
    """DM-C6 to DM-C8 by LIKE and = that ignore case: bands per spelling."""
    seg = F.col("segment")
    ws = collated(mixed_mart(spark, sf), "segment")
    age = F.when(seg != mart.NULL_SEGMENT.upper(), label_by_suffix(seg, mart.AGE_BANDS, mart.AGE_BAND_OTHER))
    out = ws.select(F.col("segment").cast("string").alias("segment"), age.alias("age_brand"),
                    label_by_prefix(seg, mart.DEMOGRAPHICS, None).alias("demographic"))
    return out.groupBy("segment", "age_brand", "demographic").agg(F.count(F.lit(1)).alias("n"))


_LETTERS = ", ".join(f"('{k}', '{v}')" for k, v in mart.DEMOGRAPHICS.items())


@register("dm_07_ci", studies.with_views(_MIXED_MART, f"""
    , labels(letter, demographic) as (values {_LETTERS})
    select lower(segment) as segment, demographic, cast(sum(transactions) as bigint) as transactions, cast(sum(sales) as double) as sales
    from mixed join labels on substr(segment, 1, 1) collate nocase = letter
    group by lower(segment), demographic"""))
def dm_07_ci(spark, sf):
    """Sales by segment and demographic, joined and grouped ignoring case."""
    ws = collated(mixed_mart(spark, sf), "segment")
    # as many rows as the study has labels
    labels = collated(spark.createDataFrame(list(mart.DEMOGRAPHICS.items()), "letter string, demographic string"), "letter")
    joined = ws.join(F.broadcast(labels), F.substring("segment", 1, 1) == F.col("letter"))
    per = joined.groupBy("segment", "demographic").agg(F.sum("transactions").alias("transactions"), F.sum("sales").alias("sales"))
    return per.select(group_key("segment").alias("segment"), "demographic", "transactions", F.col("sales").cast("double").alias("sales"))


@register("bt_c1_ci", studies.with_views(_MIXED_RETAIL, """
    select case when member collate nocase = 't' then 'member' when member collate nocase = 'f' then 'guest' else 'unknown' end as buyer,
           count(*) as n, cast(sum(qty) as bigint) as qty
    from mixed_sales group by all"""))
def bt_c1_ci(spark, sf):
    """BT-C1 with flags in either case: lines and quantity per buyer."""
    flag = flag_to_int(ci("member"))
    buyer = F.when(flag == 1, "member").when(flag == 0, "guest").otherwise("unknown")
    return mixed_sales(retail.views(spark, sf)).groupBy(buyer.alias("buyer")).agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty"))


@register("bt_01_ci", studies.with_views(_MIXED_RETAIL, """
    select lower(product_name) as product_name, count(distinct product_name) as spellings, cast(sum(qty) as bigint) as quantity_sold
    from bt_sales_raw join mixed_products on prod_id = product_id group by lower(product_name)"""))
def bt_01_ci(spark, sf):
    """Quantity per product name; names that differ by case are one group."""
    v = retail.views(spark, sf)
    sold = retail.with_products(v.sales_raw, mixed_products(v)).withColumn("spelling", F.col("product_name"))
    per = collated(sold, "product_name").groupBy("product_name").agg(
        F.countDistinct("spelling").alias("spellings"), F.sum("qty").alias("quantity_sold"))
    return per.select(group_key("product_name").alias("product_name"), "spellings", "quantity_sold")


@register("bt_19_ci", studies.with_views(_MIXED_RETAIL, """
    , pt as (select list_sort(list(distinct lower(product_name))) as l
             from bt_sales_raw join mixed_products on prod_id = product_id group by txn_id),
    i1 as (select l, unnest(range(1, len(l) + 1)) as i from pt),
    i2 as (select l, i, unnest(range(i + 1, len(l) + 1)) as j from i1),
    i3 as (select l, i, j, unnest(range(j + 1, len(l) + 1)) as k from i2)
    select l[i] as product_1, l[j] as product_2, l[k] as product_3, count(*) as combo_count
    from i3 group by 1, 2, 3 order by combo_count desc, product_1, product_2, product_3 limit 1"""))
def bt_19_ci(spark, sf):
    """Most common set of three products where case does not tell names apart."""
    v = retail.views(spark, sf)
    sold = retail.with_products(v.sales_raw, mixed_products(v)).select("txn_id", group_key(ci("product_name")).alias("product_name"))
    return most_common_triple(sold, "txn_id", "product_name")


# ---- week dates in several spellings -----------------------------------------

_MESSY = {**studies.MART_SQL, "messy": """
    select d.*, case (day(d.w) + month(d.w)) % 6
                  when 0 then d.week_date when 1 then strftime(d.w, '%d/%m/%Y')
                  when 2 then day(d.w) || '/' || month(d.w) || '/' || strftime(d.w, '%y')
                  when 3 then 'n/a' when 4 then '31/2/' || year(d.w) else strftime(d.w, '%-d-%-m-%Y') end as week_text
    from (select *, cast(strptime(week_date, '%d/%m/%Y') as date) as w from dm_weekly_sales_raw) d""", "parsed": """
    select *, regexp_matches(week_text, '^\\d{1,2}/\\d{1,2}/(\\d{4}|\\d{2})$') as known,
           try_cast(case when regexp_matches(week_text, '^\\d{1,2}/\\d{1,2}/\\d{4}$') then split_part(week_text, '/', 3)
                         when regexp_matches(week_text, '^\\d{1,2}/\\d{1,2}/\\d{2}$') then '20' || split_part(week_text, '/', 3) end
                    || '-' || split_part(week_text, '/', 2) || '-' || split_part(week_text, '/', 1) as date) as parsed_date
    from messy"""}


def messy_mart(spark, sf) -> DataFrame:
    """The raw table with ``week_text``: the week's date as typed by many hands."""
    raw = studies.resolve(spark, sf, studies.mart).weekly_sales_raw

    def spelled(w):
        k = (F.dayofmonth(w) + F.month(w)) % 6
        return (F.when(k == 1, F.date_format(w, "dd/MM/yyyy")).when(k == 2, F.date_format(w, "d/M/yy")).when(k == 3, "n/a")
                .when(k == 4, F.concat(F.lit("31/2/"), F.year(w).cast("string"))).when(k == 5, F.date_format(w, "d-M-yyyy"))
                .otherwise(F.date_format(w, "d/M/yyyy")))
    return raw.withColumn("week_text", _once(mart.parse_date("week_date", "d/M/yyyy"), spelled))


def _once(value, use):
    """``use(value)`` with the value computed once, however often it is read."""
    return F.element_at(F.transform(F.array(value), use), 1)


def parse_weeks(df: DataFrame, text: str = "week_text") -> DataFrame:
    """The parse as a step of its own: ``parsed_date`` and, where the text
    gives none, ``reason``."""
    def parsed(t):
        known = F.lit(False)
        for shape in mart.WEEK_TEXT_FORMATS:
            known = known | t.rlike(shape)
        return F.struct(mart.week_date(t).alias("date"), known.alias("known"))
    out = df.withColumn("_p", _once(F.col(text), parsed)).withColumn("parsed_date", F.col("_p.date"))
    none = F.col("parsed_date").isNull() & F.col(text).isNotNull()
    return out.withColumn("reason", F.when(none, F.when(F.col("_p.known"), "no such day").otherwise("no known form"))).drop("_p")


@register("dm_c2_parsed", studies.with_views(_MESSY, """
    select strftime(parsed_date, '%Y-%m-%d') as week_date, week_text, region, platform, segment, customer_type, transactions
    from parsed where parsed_date is not null"""))
def dm_c2_parsed(spark, sf):
    """DM-C2 on week dates of several spellings: the rows that parse."""
    ok = parse_weeks(messy_mart(spark, sf)).where(F.col("reason").isNull())
    return ok.select(F.date_format("parsed_date", "yyyy-MM-dd").alias("week_date"), "week_text", "region", "platform", "segment",
                     "customer_type", "transactions")


@register("dm_c2_rejects", studies.with_views(_MESSY, """
    select week_text, case when known then 'no such day' else 'no known form' end as reason, count(*) as n,
           cast(sum(transactions) as bigint) as transactions
    from parsed where parsed_date is null group by all"""))
def dm_c2_rejects(spark, sf):
    """The reject table of the parse: texts that are no date, and why."""
    bad = parse_weeks(messy_mart(spark, sf)).where(F.col("reason").isNotNull())
    return bad.groupBy("week_text", "reason").agg(F.count(F.lit(1)).alias("n"), F.sum("transactions").alias("transactions"))


# ---- declared lengths, missing weeks, previews -------------------------------

SEGMENT_WIDTH, WIDENED = 4, 10


@register("dm_c9_widths", studies.with_views(mart.VIEWS, f"""
    select 'segment' as col_name, cast({WIDENED} as bigint) as declared, max(length(segment)) as longest,
           {WIDENED} - max(length(segment)) as free from dm_weekly_sales
    union all
    select 'platform', 7, max(length(platform)), 7 - max(length(platform)) from dm_weekly_sales"""))
def dm_c9_widths(spark, sf):
    """DM-C9: the segment's VARCHAR is widened before DM-C10 writes a longer
    word into it; declared and used lengths afterwards."""
    raw = studies.resolve(spark, sf, studies.mart).weekly_sales_raw
    typed = as_varchar(as_varchar(mart.clean(raw, 8), "segment", SEGMENT_WIDTH), "platform", 7)
    wide = widen(typed, "segment", WIDENED)
    filled = wide.withColumn("segment", F.when(F.col("segment") == mart.NULL_SEGMENT, mart.UNKNOWN).otherwise(F.col("segment")))
    return widths(as_varchar(filled, "segment", WIDENED))


@register("dm_02_by_year", studies.with_views(mart.VIEWS, """
    select y.calendar_year, cast(n.week as bigint) as rn
    from (select distinct calendar_year from dm_weekly_sales) y, range(1, 53) as n(week)
    where not exists (select 1 from dm_weekly_sales w where w.calendar_year = y.calendar_year and w.week_number = n.week)"""))
def dm_02_by_year(spark, sf):
    """Week numbers 1..52 without sales, year by year."""
    seen = mart.views(spark, sf).select("calendar_year", F.col("week_number").cast("bigint").alias("rn")).distinct()
    weeks = seen.select("calendar_year").distinct().withColumn("rn", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(52).cast("bigint"))))
    return weeks.join(seen, ["calendar_year", "rn"], "left_anti")


@register("bt_preview", studies.with_views(studies.RETAIL_SQL, """
    select * from bt_product_details order by product_id, product_name, segment_name, category_name limit 20"""))
def bt_preview(spark, sf):
    """The first 20 products (``select *`` of the study's scripts)."""
    return preview(retail.views(spark, sf).product_details)


@register("bt_schema", studies.with_views(studies.RETAIL_SQL, """
    , counts as (select count(txn_id) as txn_id, count(prod_id) as prod_id, count(qty) as qty, count(price) as price,
                        count(discount) as discount, count(member) as member from bt_sales_raw)
    select name as col_name, replace(replace(lower(kind), 'integer', 'int'), 'varchar', 'string') as data_type, n as n_values
    from (unpivot counts on columns(*) into name name value n)
    join (select unnest(['txn_id', 'prod_id', 'qty', 'price', 'discount', 'member']) as name,
                 unnest([any_value(typeof(txn_id)), any_value(typeof(prod_id)), any_value(typeof(qty)), any_value(typeof(price)),
                         any_value(typeof(discount)), any_value(typeof(member))]) as kind from bt_sales_raw) using (name)"""))
def bt_schema(spark, sf):
    """``describe sales``: columns and types, with the number of values."""
    sales = retail.views(spark, sf).sales_raw
    counts = sales.agg(*[F.count(c).alias(c) for c in sales.columns])
    long = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).alias("n_values")) for c in sales.columns])).alias("x"))
    return describe(sales).join(long.select("x.*"), "col_name").select("col_name", "data_type", "n_values")
