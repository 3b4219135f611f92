"""Inputs of the registered queries, derived by Spark from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast import schemas
from stockcast.operators.demand import dense_demand
from stockcast.plans.preparation import clean_sources, prepare_demand, prepare_sales
from stockcast.session import materialize
from stockcast.sources import tables
from stockcast.sources.tables import promotions_from_json, small_table

AS_OF = "2001-11-01"
START = "2000-01-01"
SPECIAL = "MACHINERY"
CUTOFF = "2000-06-01"
RENAMES = [
    ("MACHINERY", "Brand#1", "Brand#2"),
    ("MACHINERY", "Brand#2", "Brand#3"),
    ("FURNITURE", "Brand#1", "Brand#9"),
]
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
}

FROM_ALL = """
  from {lineitem} join {orders} on l_orderkey = o_orderkey
  join {customer} on o_custkey = c_custkey join {supplier} on l_suppkey = s_suppkey
  join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
  join {part} on l_partkey = p_partkey"""

#: the rows of FROM_ALL for Spark: the small tables meet first, so that each order line moves once per key of its own
LINES = """
  select * from {lineitem}
  join (select * from {orders} join {customer} on o_custkey = c_custkey) on l_orderkey = o_orderkey
  join (select * from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey) on l_suppkey = s_suppkey
  join {part} on l_partkey = p_partkey"""

#: what shipments, orders and scope take from the joined rows
LINE_COLUMNS = [
    "l_linenumber", "l_quantity", "l_shipdate", "o_orderdate", "o_orderstatus", "c_mktsegment", "n_name", "r_name", "p_brand",
]

SHIPMENTS = """
  select case when l_quantity = 16 and l_linenumber = 3 then 'T10:30' else cast(l_shipdate as string) end gi_date, c_mktsegment customercode,
    case when l_linenumber = 1 then concat(' ', r_name, ' ') when l_linenumber = 6 then null
         else r_name end warehouse_code,
    case when l_linenumber = 7 and l_quantity = 50 then null
         when l_linenumber = 2 then concat(p_brand, ' ') else p_brand end sku,
    case when l_quantity = 13 then 'n/a' when l_quantity = 14 then '14d' when l_quantity = 15 then 'inf'
         else cast(l_quantity as string) end qty""" + FROM_ALL

ORDERS = """
  select cast(o_orderdate as date) order_date, c_mktsegment sendercode, r_name wh, p_brand sku,
    l_quantity qty, case when o_orderstatus <> 'P' then l_shipdate end paymentdate""" + FROM_ALL

HOLIDAYS = """
  select case when l_quantity = 7 then null
              when month(l_shipdate) = day(l_shipdate) then 'doubleday_peak'
              when day(l_shipdate) = 15 then 'midmonth_dates'
              when day(l_shipdate) = 25 then 'payday_dates'
              when (month(l_shipdate) = 4 and day(l_shipdate) = 13)
                or (month(l_shipdate) = 12 and day(l_shipdate) = 5) then 'holiday'
              else 'other_code' end holiday_code,
    case when l_quantity = 13 then 'not a date' else cast(l_shipdate as string) end ds,
    cast(case when l_linenumber = 3 then -1 when l_linenumber <> 4 then 0 end as int) lower_window,
    cast(case when l_linenumber = 5 then 1 when l_linenumber <> 4 then 0 end as int) upper_window
  from {lineitem}"""

# every order is a promotion of the SKUs it holds, 98 days on, so the last ones lie in the future
PROMOTIONS = """
  with skus as (
    select l_orderkey, collect_list(named_struct(
      'sku_code', case when l_linenumber = 7 then null else p_brand end,
      'discount_amount', l_discount,
      'discount_type', case when l_linenumber = 6 then null when l_returnflag = 'R' then 'Percent' else 'FIXED' end
    )) include_sku
    from {lineitem} join {part} on l_partkey = p_partkey group by l_orderkey)
  select to_json(array(named_struct(
    'customer_code', c_mktsegment,
    'promotion_name', concat('Order ', cast(o_orderkey as string)),
    'promotion_code', concat('P', cast(o_orderkey as string)),
    'start_date', case when o_totalprice < 5000 then 'bad' else date_format(date_add(cast(o_orderdate as date), 98), 'yyyy-MM-dd') end,
    'end_date', date_format(date_add(cast(o_orderdate as date),
        cast(98 + case when o_totalprice < 10000 then -3 else o_orderkey % 7 end as int)), 'yyyy-MM-dd'),
    'apply_mode', case when o_totalprice > 499000 then 'ALL' when o_totalprice > 498000 then null
                       when o_orderstatus = 'F' then 'include' else 'INCLUDE' end,
    'discount', named_struct('amount', o_totalprice / 100000, 'type', 'Percent'),
    'include_sku', include_sku))) promotions
  from {orders} join {customer} on o_custkey = c_custkey left join skus on l_orderkey = o_orderkey"""

CONFIG = """
  select c_mktsegment customercode,
    case when c_acctbal < 2000 then null else r_name end warehousecode,
    case when c_acctbal > 9000 then array('7', '-1', '7', 'x', '1') when c_acctbal > 4000 then array('2', '14') end lag_days,
    case when c_acctbal > 8000 then array('0') when c_acctbal > 3000 then array('5', '5') end rolling_mean_windows,
    case when c_acctbal > 9000 then 'many' when c_acctbal > 7000 then '0' when c_acctbal > 1000 then '10' end impact_top_skus_n,
    case when c_acctbal > 6000 then '-1' end impact_lower_window,
    case when c_acctbal > 5000 then '2' end impact_upper_window,
    case when c_acctbal > 3000 then '0.3' end impact_cv_band_low,
    case when c_acctbal > 6000 then '0.9' end impact_cv_band_high,
    case when c_acctbal > 7500 then 'false' end prophet_weekly_seasonality,
    case when c_acctbal > 8500 then 'true' end prophet_daily_seasonality,
    case when c_acctbal > 6500 then 'additive' end prophet_seasonality_mode,
    case when c_acctbal > 5500 then '0.25' end prophet_changepoint_prior_scale,
    case when c_acctbal > 4500 then '0.8' end prophet_changepoint_range,
    case when c_acctbal > 3500 then 'n/a' when c_acctbal > 1500 then '10' end prophet_seasonality_prior_scale,
    case when c_acctbal > 9500 then 'false' end use_promotions,
    case when c_acctbal > 2500 then 'false' end use_doubleday_peak,
    case when c_acctbal > 8800 then 'false' end use_public_holiday,
    case when c_acctbal > 7700 then 'true' end use_midmonth_dates,
    case when c_acctbal > 9200 then 'false' end use_payday_dates,
    c_acctbal > 0 is_active,
    case when c_custkey <> newest.k then timestamp_seconds(946684800 + c_custkey) end updated_at
  from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
  join (select c_mktsegment s, min(c_custkey) k from {customer} group by c_mktsegment) newest on s = c_mktsegment"""

SCOPE = """
  select case when l_linenumber = 7 then null when l_linenumber = 6 then '  ' when l_linenumber = 1
              then concat(' ', c_mktsegment) else c_mktsegment end customercode,
    case when l_linenumber = 5 then null else concat(c_mktsegment, cast(l_linenumber as string)) end customername,
    case when l_linenumber = 4 then concat(r_name, ' ') else r_name end warehousecode,
    n_name warehousename""" + FROM_ALL

# request: two listed warehouses (one unknown, one null entry), one open list, one unknown customer
REQUESTS = """
  select distinct c_mktsegment customer_code,
    case when c_mktsegment = 'MACHINERY' then array('ASIA', 'NOWHERE', null)
         when c_mktsegment = 'FURNITURE' then array() else null end warehousecodes
  from {customer} where c_mktsegment <> 'BUILDING'
  union all select distinct concat(c_mktsegment, '?'), null from {customer}"""

# what the numbers of a stored model follow from: two counts per series of the raw rows, and the version
MODEL_BASE = """
  select c_mktsegment customer_code, r_name warehousecode, p_brand Shop_SKU,
    cast(count(*) as int) n, cast(sum(l_linenumber) as int) k""" + FROM_ALL + " group by c_mktsegment, r_name, p_brand"

MODEL_VERSIONS = f"""
  select customer_code, warehousecode, Shop_SKU, n, k, 0 v, n m from ({MODEL_BASE}) a
  union all select customer_code, warehousecode, Shop_SKU, n, k, 1 v, n + 3 m from ({MODEL_BASE}) b"""


def _over(value: str, divisor: int) -> str:
    return f"({value}) / cast({divisor} as double)"


#: every number of a document as an expression of n, k, m; both engines evaluate them
MODEL_NUMBERS = {
    "span_days": "cast(600 + m % 9 as double)",
    "y_scale": "cast(20 + m % 30 as double)",
    "slope": _over("m % 7", 10),
    "level": _over("k % 5", 10) + " + " + _over("30137294871531", 100000000000000),
    "bend_1": _over("m % 3", 10),
    "bend_2": _over("0 - k % 4", 10),
    "lag_coef": _over("m % 4", 40),
    "lag_last": "cast(k % 11 as double)",
    "sigma": _over("1 + m % 6", 60),
    "holiday_1": _over("k % 9", 30),
    "holiday_2": _over("m % 8", 40),
}
MODEL_WEEK = [_over(f"{i} * (m % 5)", 50) + " - 0.1" for i in range(7)]
MODEL_YEAR = [_over(f"({i} * k) % 7", 70) + " - 0.04" for i in range(20)]

MODEL_STORE = f"""
  with documents as (
    select *, to_json(named_struct(
      'mode', case when m % 2 = 0 then 'additive' else 'multiplicative' end,
      'first_ds', cast(date_add(date '2000-01-01', m % 50) as string),
      'last_ds', cast(date_sub(date '2001-10-31', k % 3) as string),
      'span_days', {MODEL_NUMBERS["span_days"]}, 'y_scale', {MODEL_NUMBERS["y_scale"]},
      'slope', {MODEL_NUMBERS["slope"]}, 'level', {MODEL_NUMBERS["level"]},
      'change_at', array(0.25D, 0.5D), 'change_by', array({MODEL_NUMBERS["bend_1"]}, {MODEL_NUMBERS["bend_2"]}),
      'weekly', case when k % 6 = 0 then cast(array() as array<double>) else array({", ".join(MODEL_WEEK)}) end,
      'yearly', case when n % 4 = 0 then array({", ".join(MODEL_YEAR)}) else cast(array() as array<double>) end,
      'holiday_effect', map(cast(date_add(date '2001-11-01', m % 14) as string), {MODEL_NUMBERS["holiday_1"]},
        cast(date_add(date '2001-10-01', m % 9) as string), {MODEL_NUMBERS["holiday_2"]}),
      'regressors', array(
        named_struct('name', 'y_lag1', 'coef', {MODEL_NUMBERS["lag_coef"]}, 'center', 3D, 'scale', 2D, 'last', {MODEL_NUMBERS["lag_last"]}),
        named_struct('name', 'promo_flag', 'coef', 0.15D, 'center', 0D, 'scale', 1D, 'last', 0D)),
      'sigma', {MODEL_NUMBERS["sigma"]}, 'n_rows', m, 'daily_seasonality', false)) body
    from ({MODEL_VERSIONS}) versions)
  select customer_code, warehousecode, Shop_SKU,
    concat(customer_code, '/', Shop_SKU, '.json') object_path,
    case when v = 1 and n % 11 = 0 then substring(body, 1, 20) when v = 1 and n % 11 = 1 then ' \n ' when v = 1 and n % 11 = 2 then '  <html>'
         when v = 1 and n % 11 = 3 then 'oops' when v = 1 and n % 11 = 4 then '{{{{}}}}' else concat('\n', body) end model_json,
    date_sub(date '2001-10-31', k % 3) last_ds,
    case when v = 0 and k % 5 = 0 then timestamp '2001-11-01 18:00:00' when v = 0 and k % 2 = 1 then timestamp '2001-11-01 02:00:00' else timestamp '2001-11-01 14:00:00' end trained_at,
    concat('run', cast(v as string)) run_id
  from documents"""

# model documents of all kinds: JSON objects, web pages, prose and blanks
DOCUMENTS = """
  select cast(event_id as string) id, concat('  ', props) model_json from {events}
  union all select concat('p', cast(page_id as string)), html from {pages}
  union all select concat('d', cast(doc_id as string)), text from {documents}
  union all select concat('b', cast(item_id as string)), '' from {benchmark}"""


def query(spark: SparkSession, sf_dir: str, text: str, joined: DataFrame | None = None) -> DataFrame:
    """Run `text`; where it reads FROM_ALL, from `joined` if given, else from the tables joined anew."""
    text = text.replace(FROM_ALL, " from {lines}")
    read = {
        name: tables.read_table(spark, f"{sf_dir}/{name}.parquet", schema)
        for name, schema in TABLES.items()
        if "{" + name + "}" in text
    }
    if "{lines}" in text:
        read["lines"] = query(spark, sf_dir, LINES) if joined is None else joined
    return spark.sql(text, **read)


def lines(spark, sf_dir) -> DataFrame:
    """The joined rows, written down: shipments, orders and scope of one query come from one join."""
    return materialize(query(spark, sf_dir, LINES).select(*LINE_COLUMNS))


def shipments(spark, sf_dir, joined=None) -> DataFrame:
    return query(spark, sf_dir, SHIPMENTS, joined)


def orders(spark, sf_dir, joined=None) -> DataFrame:
    return query(spark, sf_dir, ORDERS, joined)


def renames(spark) -> DataFrame:
    return small_table(spark, RENAMES, tables.RENAMES)


_OPTIONS = {"as_of": AS_OF, "special_customer": SPECIAL, "cutoff": CUTOFF}


def _logs(spark, sf_dir, joined) -> tuple[DataFrame, DataFrame, DataFrame]:
    joined = lines(spark, sf_dir) if joined is None else joined
    return shipments(spark, sf_dir, joined), orders(spark, sf_dir, joined), renames(spark)


def cleaned(spark, sf_dir, joined=None) -> DataFrame:
    return clean_sources(*_logs(spark, sf_dir, joined), **_OPTIONS)


def sales(spark, sf_dir, joined=None) -> DataFrame:
    """Sums of the days with sales, written down: a query's demand, keys and pairs come from one preparation."""
    return prepare_sales(*_logs(spark, sf_dir, joined), **_OPTIONS)


def demand(spark, sf_dir, sold=None) -> DataFrame:
    """Gap-free demand, of `sold` (the days with sales) if given."""
    if sold is not None:
        return dense_demand(sold, START)
    return prepare_demand(*_logs(spark, sf_dir, None), start=START, **_OPTIONS)


def growing_demand(spark, sf_dir) -> DataFrame:
    """Demand whose series grow with the tables (one SKU per hundred parts), a third of the lines in one pair."""
    hot = "case when l_orderkey % 3 = 0 then {} else {} end"
    text = f"""
      select cast(l_shipdate as string) gi_date, {hot.format("'HOT'", "c_mktsegment")} customercode,
        {hot.format("'HOT'", "r_name")} warehouse_code, concat('P', cast(floor(l_partkey / 100) as string)) sku,
        cast(l_quantity as string) qty""" + FROM_ALL
    rows = query(spark, sf_dir, text)
    return prepare_demand(rows, orders(spark, sf_dir).limit(0), renames(spark), start=START, **_OPTIONS)


def holidays(spark, sf_dir) -> DataFrame:
    return query(spark, sf_dir, HOLIDAYS)


def promotions(spark, sf_dir) -> DataFrame:
    return promotions_from_json(query(spark, sf_dir, PROMOTIONS))


def _entry(sku: str | None) -> dict:
    return {"sku_code": sku, "discount_amount": 0.0, "discount_type": "fixed"}


def campaign(spark) -> DataFrame:
    """A few promotions for the forecasting queries, which take their demand from the tables."""
    rows = [
        ("MACHINERY", "one", "C1", "2001-10-25", "2001-11-10", "INCLUDE", None, [_entry("Brand#3"), _entry("Brand#4")]),
        ("MACHINERY", "two", "C2", "2001-11-08", "2001-11-12", "include", None, [_entry("Brand#4")]),
        ("MACHINERY", "back", "C3", "2001-11-09", "2001-11-01", "INCLUDE", None, [_entry("Brand#5")]),
        ("MACHINERY", "bad", "C4", "bad", "2001-11-01", "INCLUDE", None, [_entry("Brand#6")]),
        ("MACHINERY", "odd", "C5", "2001-10-28", "2001-10-29", "INCLUDE", None, [_entry(None), _entry("Brand#99")]),
    ]
    return small_table(spark, rows, schemas.PROMOTION)


def two_campaigns(spark) -> DataFrame:
    """The campaign, and one of a second customer on some of the same SKUs."""
    rows = [
        ("FURNITURE", "late", "D1", "2001-11-03", "2001-11-06", "INCLUDE", None, [_entry("Brand#4"), _entry("Brand#7")]),
        ("FURNITURE", "next", "D2", "2001-11-06", "2001-11-08", "INCLUDE", None, [_entry("Brand#7"), _entry("Brand#98")]),
    ]
    return campaign(spark).unionByName(small_table(spark, rows, schemas.PROMOTION))


def config(spark, sf_dir) -> DataFrame:
    return query(spark, sf_dir, CONFIG)


def scope(spark, sf_dir, joined=None) -> DataFrame:
    return query(spark, sf_dir, SCOPE, joined)


def requests(spark, sf_dir) -> DataFrame:
    return query(spark, sf_dir, REQUESTS)


def model_store(spark, sf_dir) -> DataFrame:
    """Two stored versions of each series' model, both of one day; some of the newer ones are broken."""
    return query(spark, sf_dir, MODEL_STORE)


def documents(spark, sf_dir) -> DataFrame:
    return query(spark, sf_dir, DOCUMENTS)


def stand_in_forecast(daily: DataFrame) -> DataFrame:
    """A forecast both engines can compute: each series' mean by weekday, from October 2001 on."""
    mean = daily.groupBy("customer_code", "warehousecode", "Shop_SKU").agg(F.round(F.avg("y"), 6).alias("m"))
    days = F.sequence(F.lit("2001-10-01").cast("date"), F.lit("2001-11-20").cast("date"))
    rows = mean.withColumn("ds", F.explode(days))
    yhat = F.col("m") + (F.weekday("ds") - 3) * 0.5
    return rows.select(
        "ds", "customer_code", "warehousecode", "Shop_SKU",
        yhat.alias("yhat"), (yhat - 2).alias("yhat_lower"), (yhat + 2).alias("yhat_upper"),
    )


def rough_forecast(spark, sf_dir) -> DataFrame:
    """Forecast values of every awkward kind, one per order line."""
    return query(
        spark, sf_dir,
        """select l_orderkey, l_linenumber, l_partkey,
             case when l_linenumber = 1 then null when l_linenumber = 2 then double('NaN')
                  when l_linenumber = 3 then double('Infinity') when l_linenumber = 4 then -l_quantity
                  else l_quantity / 2 end yhat,
             l_quantity / 4 - 1 yhat_lower, l_quantity * 1.5 yhat_upper
           from {lineitem}""",
    )
