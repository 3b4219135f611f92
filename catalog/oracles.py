"""SQL counterparts of the registered queries, for DuckDB over the same tables.

Each oracle is one select over named steps; `_sql` puts the steps it needs in front.
"""

from __future__ import annotations

import re

from catalog import fixtures as fx
from stockcast.schemas import SETTING_TYPES
from stockcast.settings import DEFAULT_SETTINGS

SERIES = "customer_code, warehousecode, Shop_SKU"


def _input(text: str) -> str:
    plain = re.sub(r"\{(\w+)\}", r"\1", text)
    return plain.replace("array(", "list_value(").replace(
        "timestamp_seconds(946684800 + c_custkey)", "make_timestamp((946684800 + c_custkey) * 1000000)"
    )


_OFFSET = "case when o_totalprice < 10000 then -3 else o_orderkey % 7 end"

STEPS: dict[str, str] = {
    "gi": _input(fx.SHIPMENTS),
    "ol": _input(fx.ORDERS),
    "sku_map": "select * from (values "
    + ", ".join(str(r) for r in fx.RENAMES)
    + ") t(customer_code, old_sku, new_sku)",
    "gi_clean": f"""
        select try_cast(gi_date as timestamp)::date ds, trim(customercode) customer_code,
          coalesce(trim(warehouse_code), 'None') warehousecode, trim(sku) Shop_SKU,
          case when isfinite(try_cast(qty as double)) then try_cast(qty as double) else 0.0 end y, cast(null as date) paymentdate
        from gi where sku is not null and try_cast(gi_date as timestamp)::date < date '{fx.AS_OF}'""",
    "ol_clean": f"""
        select order_date ds, trim(sendercode) customer_code, coalesce(trim(wh), 'None') warehousecode,
          trim(sku) Shop_SKU, coalesce(qty, 0.0) y, paymentdate::date paymentdate
        from ol where sku is not null and order_date < date '{fx.AS_OF}'""",
    "cleaned": f"""
        select ds, r.customer_code, warehousecode, coalesce(new_sku, Shop_SKU) Shop_SKU, y from (
          select * from gi_clean where customer_code <> '{fx.SPECIAL}'
          union all
          select * from ol_clean where customer_code = '{fx.SPECIAL}' and ds >= date '{fx.CUTOFF}'
            and paymentdate is not null) r
        left join sku_map m on m.customer_code = r.customer_code and m.old_sku = r.Shop_SKU""",
    "daily": f"select ds, {SERIES}, sum(y) y from cleaned group by all",
    "keys": f"select distinct {SERIES} from cleaned",
    "spine": f"""
        select unnest(generate_series(timestamp '{fx.START}', (select max(ds) from cleaned)::timestamp,
          interval 1 day))::date ds""",
    "demand": f"""
        select s.ds, k.customer_code, k.warehousecode, k.Shop_SKU, coalesce(d.y, 0.0) y
        from spine s cross join keys k left join daily d on d.ds = s.ds
          and d.customer_code = k.customer_code and d.warehousecode = k.warehousecode and d.Shop_SKU = k.Shop_SKU""",
    "latest": "select customer_code, warehousecode, max(ds) latest_date from demand group by all",
    "train": "select d.* from demand d join latest using (customer_code, warehousecode) where ds < latest_date",
    "test": "select d.* from demand d join latest using (customer_code, warehousecode) where ds > latest_date - 30",
    "profile": f"select {SERIES}, sum(y) volume, stddev_samp(y) / nullif(avg(y), 0) cv from train group by all",
    "ranked": """select *, row_number() over (partition by customer_code, warehousecode
        order by volume desc, Shop_SKU) as rank from profile""",
    "zscores": f"""
        select ds, {SERIES}, y, rule,
          (y - case rule when 0 then m10 when 1 then m7 else m5 end)
            / nullif(case rule when 0 then s10 when 1 then s7 else s5 end, 0) z_score,
          case rule when 0 then 2.5::double when 1 then 2.0 else 1.5 end threshold, rank
        from (select t.*, rank, case when cv is null or cv < 0.2 then 0 when cv < 0.6 then 1 else 2 end rule,
            case when count(*) over w10 = 10 then avg(y) over w10 end m10,
            case when count(*) over w10 = 10 then stddev_samp(y) over w10 end s10,
            case when count(*) over w7 = 7 then avg(y) over w7 end m7,
            case when count(*) over w7 = 7 then stddev_samp(y) over w7 end s7,
            case when count(*) over w5 = 5 then avg(y) over w5 end m5,
            case when count(*) over w5 = 5 then stddev_samp(y) over w5 end s5
          from train t join ranked using ({SERIES})
          window w10 as (partition by {SERIES} order by ds rows between 9 preceding and current row),
            w7 as (partition by {SERIES} order by ds rows between 6 preceding and current row),
            w5 as (partition by {SERIES} order by ds rows between 4 preceding and current row))""",
    "impact": "select distinct customer_code, warehousecode, ds from zscores where rank <= 30 and abs(z_score) > threshold",
    "pareto": f"""
        select {SERIES}, volume from (
          select *, sum(volume) over (partition by customer_code, warehousecode
              order by volume desc, Shop_SKU rows unbounded preceding)
            / sum(volume) over (partition by customer_code, warehousecode) share from ranked)
        qualify share <= 0.8 or (rank = 1 and min(share) over (partition by customer_code, warehousecode) > 0.8)""",
    "holiday_raw": _input(fx.HOLIDAYS),
    "holidays": """
        select distinct holiday_code holiday, try_cast(ds as timestamp)::date ds, lower_window, upper_window
        from holiday_raw where holiday_code is not null and try_cast(ds as timestamp) is not null""",
    "promo_head": f"""
        select o_orderkey, c_mktsegment customer_code, concat('Order ', o_orderkey) promotion_name,
          concat('P', o_orderkey) promotion_code,
          case when o_totalprice < 5000 then 'bad' else cast(o_orderdate::date + 98 as varchar) end start_date,
          cast(o_orderdate::date + cast(98 + {_OFFSET} as int) as varchar) end_date,
          case when o_totalprice > 498000 then 'ALL' else 'INCLUDE' end apply_mode, o_totalprice
        from orders join customer on o_custkey = c_custkey""",
    "promo_lines": """
        select l_orderkey, case when l_linenumber <> 7 then p_brand end sku_code, l_discount discount_amount,
          case when l_linenumber = 6 then '' when l_returnflag = 'R' then 'percent' else 'fixed' end discount_type
        from lineitem join part on l_partkey = p_partkey""",
    "master": """
        select customer_code, promotion_name, promotion_code, start_date, end_date, apply_mode,
          cast(null as varchar) sku_code, o_totalprice / 100000 discount_amount, 'percent' discount_type
        from promo_head where apply_mode = 'ALL'
        union all
        select customer_code, promotion_name, promotion_code, start_date, end_date, apply_mode,
          sku_code, discount_amount, discount_type
        from promo_head join promo_lines on l_orderkey = o_orderkey where apply_mode = 'INCLUDE'""",
    "valid": """
        select customer_code, apply_mode, try_cast(start_date as date) start_date, try_cast(end_date as date) end_date, sku_code
        from master where try_cast(end_date as date) >= try_cast(start_date as date)""",
    "ranges": """
        select distinct start_date, end_date, sku_code Shop_SKU from valid where apply_mode <> 'ALL' and sku_code is not null
        union all
        select distinct v.start_date, v.end_date, k.Shop_SKU from valid v
          cross join (select distinct Shop_SKU from keys) k where apply_mode = 'ALL'""",
    "promo": """
        select distinct unnest(generate_series(start_date::timestamp, end_date::timestamp, interval 1 day))::date ds,
          Shop_SKU, 1 promo_flag from ranges""",
    "campaign": """
        select distinct unnest(generate_series(a, b, interval 1 day))::date ds, Shop_SKU, 1 promo_flag from (values
          (timestamp '2001-10-25', timestamp '2001-11-10', 'Brand#3'), (timestamp '2001-10-25', timestamp '2001-11-10', 'Brand#4'),
          (timestamp '2001-11-08', timestamp '2001-11-12', 'Brand#4'), (timestamp '2001-10-28', timestamp '2001-10-29', 'Brand#99')
        ) t(a, b, Shop_SKU)""",
    "lagged": f"""
        select *, lag(y, 1) over w y_lag1, lag(y, 7) over w y_lag7, lag(y, 14) over w y_lag14,
          case when count(*) over b3 = 3 then avg(y) over b3 end rolling_mean_3,
          case when count(*) over b28 = 28 then avg(y) over b28 end rolling_mean_28
        from demand window w as (partition by {SERIES} order by ds),
          b3 as (partition by {SERIES} order by ds rows between 3 preceding and 1 preceding),
          b28 as (partition by {SERIES} order by ds rows between 28 preceding and 1 preceding)""",
    "spans": f"""
        select {SERIES}, greatest(avg(y), 0.0) rate, min(ds) first_ds, max(ds) last_ds from demand group by all""",
    "config_raw": _input(fx.CONFIG),
    "scope_raw": _input(fx.SCOPE),
    "scope": """
        select trim(customercode) customercode, min(coalesce(customername, '')) customername,
          trim(warehousecode) warehousecode, min(coalesce(warehousename, '')) warehousename
        from scope_raw where customercode is not null and warehousecode is not null
          and trim(customercode) <> '' and trim(warehousecode) <> '' group by 1, 3""",
    "requests": _input(fx.REQUESTS),
    "wanted": """
        select customer_code, unnest(warehousecodes) warehousecode from requests where len(warehousecodes) > 0
        union
        select r.customer_code, s.warehousecode from requests r join scope s on s.customercode = r.customer_code
        where coalesce(len(warehousecodes), 0) = 0""",
    "wanted_pairs": "select * from wanted where warehousecode is not null",
    "forecast": f"""
        select d::date ds, {SERIES}, m + (isodow(d) - 4) * 0.5 yhat, m + (isodow(d) - 4) * 0.5 - 2 yhat_lower,
          m + (isodow(d) - 4) * 0.5 + 2 yhat_upper
        from (select {SERIES}, round(avg(y), 6) m from demand group by all)
          cross join (select unnest(generate_series(timestamp '2001-10-01', timestamp '2001-11-20', interval 1 day)) d)""",
    "bias": f"""
        select {SERIES}, case when sum(y) >= 50 and count(case when y > yhat then 1 end) >= 3
            then median(case when y > yhat then y - yhat end) else 0.0 end correction
        from test t join forecast f using ({SERIES}, ds) group by all""",
}


def _int(c: str) -> str:
    return f"try_cast({c} as int)"


def _ints(c: str) -> str:
    return f"""case when len(list_filter({c}, lambda x: try_cast(x as int) > 0)) > 0 then
        list_reduce(list_transform(list_filter({c}, lambda x: try_cast(x as int) > 0), lambda x: list_value(try_cast(x as int))),
          lambda a, b: case when list_contains(a, b[1]) then a else list_concat(a, b) end) end"""


def _setting(name: str) -> str:
    kind = SETTING_TYPES[name]
    if name.startswith("promo_"):  # not in the table
        return f"cast(null as {kind})"
    if name == "impact_top_skus_n":
        return f"greatest(1, {_int(name)}) * ({_int(name)} * 0 + 1)"
    if name.startswith("impact_cv_band"):
        both = "try_cast(impact_cv_band_low as double) + try_cast(impact_cv_band_high as double)"
        return f"case when ({both}) is not null then try_cast({name} as double) end"
    return _ints(name) if kind.startswith("ARRAY") else f"try_cast({name} as {kind.replace('STRING', 'VARCHAR')})"


_NAMES = list(SETTING_TYPES)
STEPS["config"] = (
    "select customercode, warehousecode, is_active, updated_at, "
    + ", ".join(f"{_setting(n)} {n}" for n in _NAMES)
    + " from config_raw"
)
STEPS["found"] = f"""
    select p.customer_code, p.warehousecode,
      case when c.customercode is null then null when c.warehousecode is null then 'customer' else 'warehouse' end config_level,
      {", ".join(f"c.{n}" for n in _NAMES)}
    from (select customercode customer_code, warehousecode from scope) p
    left join config c on c.is_active and c.customercode = p.customer_code
      and (c.warehousecode = p.warehousecode or c.warehousecode is null)
    qualify row_number() over (partition by p.customer_code, p.warehousecode
      order by case when c.warehousecode is null then 2 else 1 end, updated_at desc nulls first) = 1"""

STEPS["found_for_demand"] = STEPS["found"].replace(
    "select customercode customer_code, warehousecode from scope", "select distinct customer_code, warehousecode from keys"
)


def _default(name: str) -> str:
    value = DEFAULT_SETTINGS[name]
    if isinstance(value, list):
        return f"list_value({', '.join(map(str, value))})"
    return f"'{value}'" if isinstance(value, str) else str(value).lower()


# the request's usable values: an empty list stands for the built-in one, at least one SKU is ranked, the rest does not parse
_REQUESTED = {
    "prophet_seasonality_mode": "'additive'", "impact_top_skus_n": "1", "lag_days": "list_value(7, 3)",
    "rolling_mean_windows": "list_value(3)",
}
STEPS["effective"] = "select customer_code, warehousecode, " + ", ".join(
    _REQUESTED.get(n, f"coalesce({n}, {_default(n)})") + f" {n}" for n in _NAMES
) + " from found"

# the newest version of each stored model, with its numbers
_BROKEN = "case n % 11 when 0 then 'broken json' when 1 then 'empty' when 2 then 'html' when 3 then 'not json' when 4 then 'incomplete' else 'ok' end"
STEPS["versions"] = _input(fx.MODEL_VERSIONS)
STEPS["models"] = (
    f"select *, concat('run', v) run_id, case when v = 1 then {_BROKEN} else 'ok' end state, "
    "date '2000-01-01' + m % 50 first_ds, date '2001-10-31' - k % 3 last_ds, "
    + ", ".join(f"{text} {name}" for name, text in fx.MODEL_NUMBERS.items())
    + " from versions where v = case when k % 5 = 0 then 0 else 1 end"
)
_ANGLE = "((ds - date '1970-01-01') * (2 * pi() / 365.25))"
_YEARLY = " + ".join(
    f"(({fx.MODEL_YEAR[2 * i - 2]}) * sin({_ANGLE} * {i}) + ({fx.MODEL_YEAR[2 * i - 1]}) * cos({_ANGLE} * {i}))" for i in range(1, 11)
)


def _predicted(first: str, lag: str, campaign: str = "campaign", also: str = "") -> str:
    """The published formula over the days from `first` to 14 days after the training data."""
    return f"""
    select ds, {SERIES}, promo_flag, z.y_scale * case when m % 2 = 0 then trend + effect else trend * (1 + effect) end yhat,
      1.2815515655446004 * z.y_scale * sqrt(z.sigma * z.sigma + case when m % 2 = 0 then 1 else (1 + effect) * (1 + effect) end
        * 2 * power(abs(bend_1) + abs(bend_2), 2) / 2 / 3 * power(greatest(t - 1, 0), 3)) margin
    from (select x.*,
        level + slope * t + bend_1 * greatest(t - 0.25, 0) + bend_2 * greatest(t - 0.5, 0) trend,
        case when k % 6 = 0 then 0 else list_extract(list_value({", ".join(fx.MODEL_WEEK)}), isodow(ds)::int) end
          + case when n % 4 = 0 then {_YEARLY} else 0 end
          + case when ds = date '2001-11-01' + m % 14 then holiday_1 when ds = date '2001-10-01' + m % 9 then holiday_2 else 0 end
          + lag_coef * ({lag} - 3) / 2 + 0.15 * promo_flag effect
      from (select d.*, coalesce(c.promo_flag, 0) promo_flag, (d.ds - first_ds) / span_days t
        from (select *, unnest(generate_series({first}::timestamp, last_ds::timestamp + interval 14 day, interval 1 day))::date ds
          from models where state = 'ok') d
        left join {campaign} c on c.ds = d.ds and c.Shop_SKU = d.Shop_SKU{also}) x) z"""


STEPS["predicted"] = _predicted("first_ds", "lag_last")
STEPS["scored"] = _predicted("(last_ds + 1)", "0")
STEPS["own_campaign"] = """
    select distinct unnest(generate_series(a, b, interval 1 day))::date ds, customer_code, Shop_SKU, 1 promo_flag from (values
      ('MACHINERY', timestamp '2001-10-25', timestamp '2001-11-10', 'Brand#3'), ('MACHINERY', timestamp '2001-10-25', timestamp '2001-11-10', 'Brand#4'),
      ('MACHINERY', timestamp '2001-11-08', timestamp '2001-11-12', 'Brand#4'), ('MACHINERY', timestamp '2001-10-28', timestamp '2001-10-29', 'Brand#99'),
      ('FURNITURE', timestamp '2001-11-03', timestamp '2001-11-06', 'Brand#4'), ('FURNITURE', timestamp '2001-11-03', timestamp '2001-11-06', 'Brand#7'),
      ('FURNITURE', timestamp '2001-11-06', timestamp '2001-11-08', 'Brand#7'), ('FURNITURE', timestamp '2001-11-06', timestamp '2001-11-08', 'Brand#98')
    ) t(customer_code, a, b, Shop_SKU)"""
STEPS["own_listed"] = """select * from (values
    ('MACHINERY', 'Brand#3'), ('MACHINERY', 'Brand#4'), ('MACHINERY', 'Brand#5'), ('MACHINERY', 'Brand#6'), ('MACHINERY', 'Brand#99'),
    ('FURNITURE', 'Brand#4'), ('FURNITURE', 'Brand#7'), ('FURNITURE', 'Brand#98')) t(customer_code, Shop_SKU)"""
STEPS["scored_by_customer"] = _predicted("(last_ds + 1)", "0", "own_campaign", " and c.customer_code = d.customer_code")
_SCORED_COUNTS = f"""select ds, {SERIES}, round_even(greatest(yhat, 0), 0)::bigint yhat, round_even(greatest(yhat - margin, 0), 0)::bigint yhat_lower,
    round_even(greatest(yhat + margin, 0), 0)::bigint yhat_upper, promo_flag from scored"""
_LISTED = "('Brand#3', 'Brand#4', 'Brand#5', 'Brand#6', 'Brand#99')"
STEPS["effective_db"] = "select customer_code, warehousecode, " + ", ".join(
    f"coalesce({n}, {_default(n)}) {n}" for n in _NAMES
) + " from found"


def _texts(names: list[str]) -> str:
    return ", ".join(
        f"array_to_string({n}, ',') {n}" if SETTING_TYPES.get(n, "").startswith("ARRAY") else n for n in names
    )


def _sql(select: str, *extra: tuple[str, str]) -> str:
    steps = {**STEPS, **dict(extra)}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in steps:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                visit(steps[name])
                if name not in needed:
                    needed.append(name)

    visit(select)
    return "with " + ",\n".join(f"{n} as ({steps[n]})" for n in needed) + "\n" + select if needed else select


def _poisson_table(means: str) -> str:
    """Cumulative probabilities of every count that matters, per mean."""
    return f"""
      select mean, k, sum(exp(k * ln(mean) - mean - lgamma(k + 1))) over (partition by mean order by k) cdf
      from (select mean, unnest(generate_series(greatest(0, floor(mean - 12 * sqrt(mean) - 10))::bigint,
        ceil(mean + 12 * sqrt(mean) + 30)::bigint)) k from ({means}) where mean > 0)"""


_BOUNDS = """
    select mean, min(case when cdf >= 0.025 then k end) yhat_lower, min(case when cdf >= 0.975 then k end) yhat_upper
    from cdfs group by mean"""


def _job_steps(route: str) -> tuple[tuple[str, str], ...]:
    """Rows of a training run: exact draws of the series that are not routed to a model, days alone of the others."""
    return (
        ("chosen", route),
        ("lead", f"""select {SERIES}, greatest(list_max(coalesce(lag_days, list_value(1, 7))),
            list_max(coalesce(rolling_mean_windows, list_value(3)))) n from keys join found_for_demand using (customer_code, warehousecode)"""),
        ("drawn_spans", f"select s.* from spans s left join chosen c using ({SERIES}) where c.Shop_SKU is null"),
        ("tables", "select mean, min(k) first_k, list(cdf order by k) cdf from (" + _poisson_table("select distinct rate as mean from spans") + ") group by mean"),
        ("days", f"""select {SERIES}, rate, unnest(generate_series(first_ds::timestamp, last_ds::timestamp + interval 14 day, interval 1 day))::date ds from drawn_spans"""),
        ("draws", f"""select ds, {SERIES}, case when rate > 0 then first_k + len(list_filter(cdf, lambda c: c < u)) else 0 end::bigint yhat
            from (select *, cast(concat('0x', substr(md5(concat_ws('|', {SERIES}, ds, '42')), 1, 8)) as bigint) / 4294967296.0::double u from days)
            left join tables on tables.mean = rate"""),
        ("cdfs", _poisson_table("select distinct yhat::double as mean from draws")),
        ("bounds", _BOUNDS),
        ("job_rows", f"""
            select ds, {SERIES}, yhat, coalesce(yhat_lower, 0)::bigint yhat_lower, coalesce(yhat_upper, 0)::bigint yhat_upper, 'poisson' as method
            from draws left join bounds on bounds.mean = draws.yhat
            union all
            select unnest(generate_series(first_ds::timestamp + to_days(n::int), last_ds::timestamp + interval 14 day, interval 1 day))::date ds,
              {SERIES}, null, null, null, 'structural' from spans join chosen using ({SERIES}) join lead using ({SERIES})"""),
    )


_SHAPED = f"""
    select case when yhat >= 0 then ds end::timestamp ds, customer_code customercode, warehousecode, Shop_SKU,
      trunc(yhat)::bigint yhat from forecast"""

_JOB_ROUTE = f"""select {SERIES} from pareto union select {SERIES} from keys join found_for_demand using (customer_code, warehousecode)
    where Shop_SKU in (select Shop_SKU from campaign) and coalesce(use_promotions, true)"""
_SETTINGS_ROUTE = f"select {SERIES} from pareto union select {SERIES} from keys where Shop_SKU in (select Shop_SKU from campaign)"

ORACLES: dict[str, str] = {
    "scan_gi": _sql(f"select * from gi where customercode <> '{fx.SPECIAL}'"),
    "scan_orders": _sql(f"select * replace (paymentdate::date as paymentdate) from ol where sendercode = '{fx.SPECIAL}'"),
    "adapt_gi": _sql("select gi_date ds, customercode customer_code, warehouse_code warehousecode, sku Shop_SKU, qty y, cast(null as varchar) paymentdate from gi"),
    "adapt_order": _sql("select order_date ds, sendercode customer_code, wh warehousecode, sku Shop_SKU, qty y, paymentdate::date paymentdate from ol"),
    "clean_demand": _sql("select * from gi_clean"),
    "sku_remap": _sql("""select ds, r.customer_code, warehousecode, coalesce(new_sku, Shop_SKU) Shop_SKU, y, paymentdate
        from ol_clean r left join sku_map m on m.customer_code = r.customer_code and m.old_sku = r.Shop_SKU"""),
    "customer_rules": _sql(f"""select * from ol_clean where customer_code <> '{fx.SPECIAL}'
        or (ds >= date '{fx.CUTOFF}' and paymentdate is not null)"""),
    "union_sources": _sql("select * from cleaned"),
    "demand_profile": _sql("""select count(*) n_rows, sum(y) sum_y, count(case when y > 0 then 1 end) nonzero_rows,
        count(distinct Shop_SKU) n_skus from cleaned"""),
    "top_pairs": _sql("""select customer_code, warehousecode, sum(y) sum_y from cleaned group by all
        order by sum_y desc, customer_code, warehousecode limit 5"""),
    "daily_demand": _sql("select * from daily"),
    "series_keys": _sql("select * from keys"),
    "date_spine": _sql("select * from spine"),
    "dense_demand": _sql("select * from demand"),
    "prep_demand": _sql("select * from demand"),
    "filter_scope": _sql("select * from demand where (customer_code, warehousecode) in (select customer_code, warehousecode from wanted_pairs)"),
    "validate_inputs": _sql("""select customer_code, warehousecode, count(*) n_rows, count(case when ds < latest_date then 1 end) train_rows,
        sum(case when ds < latest_date then y else 0 end) train_volume,
        case when count(case when ds < latest_date then 1 end) = 0 then 'train is empty'
          when sum(case when ds < latest_date then y else 0 end) <= 0 then 'total volume is 0' end reason
        from demand join latest using (customer_code, warehousecode) group by all"""),
    "train_split": _sql("select * from train"),
    "test_split": _sql("select * from test"),
    "missing_days": _sql(f"""select customer_code, warehousecode, max(ds) last_ds, date '{fx.AS_OF}' - 1 expected_last,
        greatest(0, (date '{fx.AS_OF}' - 1) - max(ds))::int dif_days from daily group by all"""),
    "collapse_warehouses": _sql("select ds, customer_code, 'prophet' warehousecode, Shop_SKU, sum(y) y from demand group by all"),
    "sku_volume": _sql(f"select {SERIES}, volume from profile"),
    "sku_cv": _sql(f"select {SERIES}, round(cv, 6) cv from profile"),
    "top_skus": _sql(f"select {SERIES}, volume, rank::int rank from ranked where rank <= 10"),
    "zscore_detail": _sql(f"""select ds, {SERIES}, y, rule, round(z_score, 6) z_score, threshold from zscores where rank <= 10"""),
    "impact_dates": _sql("select * from impact"),
    "pareto_skus": _sql("select * from pareto"),
    "sku_override": _sql("select * from demand where Shop_SKU in ('Brand#3', 'Brand#4', 'Brand#5', 'Brand#6', 'Brand#99')"),
    "base_holidays": _sql("""select holiday, ds, lower_window, upper_window from holidays"""),
    "holiday_toggles": _sql("""select customer_code, warehousecode, holiday, ds, lower_window, upper_window
        from holidays cross join effective_db e
        where (holiday = 'doubleday_peak' and use_doubleday_peak) or (holiday = 'holiday' and use_public_holiday)
          or (holiday = 'midmonth_dates' and use_midmonth_dates) or (holiday = 'payday_dates' and use_payday_dates)"""),
    "impact_dates_request": _sql(f"""select distinct customer_code, warehousecode, ds from (
        select t.*, rank, (y - case when count(*) over w = 7 then avg(y) over w end) / nullif(stddev_samp(y) over w, 0) z
        from train t join ranked using ({SERIES}) window w as (partition by {SERIES} order by ds rows between 6 preceding and current row))
        where rank <= 30 and abs(z) > 2.25"""),
    "holidays_with_impact": _sql("""select * from holidays where holiday in ('doubleday_peak', 'midmonth_dates', 'payday_dates')
        union select 'impact_dates', ds, 0, 1 from impact"""),
    "holiday_features": _sql("""select distinct concat(holiday, case when k < 0 then '_minus_' else '_plus_' end, abs(k)) feature,
        ds + k::int ds from (select holiday, ds, unnest(generate_series(
          least(coalesce(lower_window, 0), coalesce(upper_window, 0)), coalesce(upper_window, 0))) k from holidays)"""),
    "series_holidays": _sql(f"""select {SERIES}, 'impact_dates' holiday, ds, 0 lower_window, 1 upper_window
        from keys join impact using (customer_code, warehousecode)
        union all select {SERIES}, 'promotion', ds, 0, 1 from keys join campaign using (Shop_SKU)"""),
    "promo_master": _sql("select * replace (round(discount_amount, 6) as discount_amount) from master"),
    "promo_master_valid": _sql("select * from valid"),
    "promo_daily": _sql("select * from promo"),
    "promo_daily_by_customer": _sql(
        """select distinct unnest(generate_series(start_date::timestamp, end_date::timestamp, interval 1 day))::date ds,
          customer_code, Shop_SKU, 1 promo_flag from own_ranges""",
        ("own_ranges", """
        select distinct customer_code, start_date, end_date, sku_code Shop_SKU from valid where apply_mode <> 'ALL' and sku_code is not null
        union all
        select distinct v.customer_code, v.start_date, v.end_date, k.Shop_SKU from valid v
          join (select distinct customer_code, Shop_SKU from keys) k using (customer_code) where apply_mode = 'ALL'"""),
    ),
    "promo_holidays": _sql("select 'promotion' holiday, ds, -1 lower_window, 2 upper_window, Shop_SKU from promo"),
    "promo_skus": _sql("""select distinct sku_code Shop_SKU from promo_lines where sku_code is not null"""),
    "promo_worklist": _sql(f"select distinct '{fx.SPECIAL}' customer_code, sku_code Shop_SKU, 14 periods from promo_lines where sku_code is not null"),
    "promo_window": _sql("select min(ds) promo_start, max(ds) promo_end, count(distinct Shop_SKU) n_promo_skus from promo"),
    "lag_features": _sql(f"select ds, {SERIES}, y, y_lag1, y_lag7, round(rolling_mean_3, 6) rolling_mean_3 from lagged"),
    "promo_regressor": _sql("select d.*, coalesce(promo_flag, 0) promo_flag from demand d left join campaign using (ds, Shop_SKU)"),
    "series_features": _sql(f"""select ds, {SERIES}, y, y_lag1, y_lag7, y_lag14, round(rolling_mean_3, 6) rolling_mean_3,
        round(rolling_mean_28, 6) rolling_mean_28, coalesce(promo_flag, 0) promo_flag
        from lagged left join promo using (ds, Shop_SKU)
        where y_lag1 is not null and y_lag7 is not null and y_lag14 is not null and rolling_mean_3 is not null and rolling_mean_28 is not null"""),
    "last_known_features": _sql(f"""select {SERIES}, y_lag1, y_lag7, round(rolling_mean_3, 6) rolling_mean_3 from lagged
        where y_lag7 is not null qualify row_number() over (partition by {SERIES} order by ds desc) = 1"""),
    "promo_days_in_train": _sql(f"""select {SERIES}, cast(count(promo_flag) as bigint) promo_days
        from lagged left join campaign using (ds, Shop_SKU) where y_lag7 is not null group by all"""),
    "future_frame": _sql(f"""select f.ds, {SERIES}, coalesce(promo_flag, 0) promo_flag from (
          select {SERIES}, unnest(generate_series(first_ds::timestamp, last_ds::timestamp + interval 14 day, interval 1 day))::date ds from spans) f
        left join campaign using (ds, Shop_SKU)"""),
    "config_coerce": _sql(f"""select customercode, warehousecode, is_active, cast(updated_at as varchar) updated_at, {_texts(_NAMES)},
        least(1.0, greatest(0.0, coalesce(prophet_changepoint_range * 2, 0.8))) volume_share from config"""),
    "config_lookup": _sql(f"select customer_code, warehousecode, config_level, {_texts(_NAMES)} from found"),
    "config_effective": _sql(f"select customer_code, warehousecode, {_texts(_NAMES)} from effective"),
    "scope_pairs": _sql("select * from scope"),
    "resolve_scope": _sql("select * from wanted_pairs"),
    "poisson_rate": _sql(f"select {SERIES}, round(rate, 6) rate, first_ds, last_ds from spans"),
    "poisson_quantiles": _sql(
        """select m.mean, coalesce(yhat_lower, 0) yhat_lower, coalesce(yhat_upper, 0) yhat_upper
        from (select distinct y as mean from daily) m left join bounds using (mean)""",
        ("cdfs", _poisson_table("select distinct y as mean from daily")),
        ("bounds", _BOUNDS),
    ),
    "poisson_forecast": _sql(
        f"""select ds, {SERIES}, yhat, coalesce(yhat_lower, 0) yhat_lower, coalesce(yhat_upper, 0) yhat_upper
        from draws left join bounds on bounds.mean = draws.yhat""",
        ("tables", "select mean, min(k) first_k, list(cdf order by k) cdf from (" + _poisson_table("select distinct rate as mean from spans") + ") group by mean"),
        ("days", f"""select {SERIES}, rate, unnest(generate_series(first_ds::timestamp, last_ds::timestamp + interval 14 day, interval 1 day))::date ds from spans"""),
        ("draws", f"""select ds, {SERIES}, case when rate > 0 then first_k + len(list_filter(cdf, lambda c: c < u)) else 0 end::bigint yhat
            from (select *, cast(concat('0x', substr(md5(concat_ws('|', {SERIES}, ds, '42')), 1, 8)) as bigint) / 4294967296.0::double u from days)
            left join tables on tables.mean = rate"""),
        ("cdfs", _poisson_table("select distinct yhat::double as mean from draws")),
        ("bounds", _BOUNDS),
    ),
    "model_skus": _sql(_SETTINGS_ROUTE),
    "forecast_route": _sql(f"""select {SERIES}, case when chosen.Shop_SKU is null then 'poisson' else 'structural' end as method
        from keys left join chosen using ({SERIES})""", ("chosen", _SETTINGS_ROUTE)),
    "forecast_route_all_promoted": _sql(f"select {SERIES}, 'structural' as method from keys"),
    "int_cleanup": """select l_orderkey, l_linenumber, l_partkey,
        case when l_linenumber <= 4 then 0 else round_even(l_quantity / 2, 0)::bigint end yhat,
        round_even(greatest(l_quantity / 4 - 1, 0), 0)::bigint yhat_lower, round_even(l_quantity * 1.5, 0)::bigint yhat_upper from lineitem""",
    "bias_correction": _sql(f"select {SERIES}, round(correction, 6) correction from bias"),
    "bias_apply": _sql(f"""select ds, {SERIES}, round_even(yhat + coalesce(correction, 0), 0)::bigint yhat,
        round(yhat_lower, 6) yhat_lower, round(yhat_upper, 6) yhat_upper from forecast left join bias using ({SERIES})"""),
    "forecast_promo_flag": _sql(f"""select ds, {SERIES}, round(yhat, 6) yhat, round(yhat_lower, 6) yhat_lower,
        round(yhat_upper, 6) yhat_upper, coalesce(promo_flag, 0) promo_flag from forecast left join promo using (ds, Shop_SKU)"""),
    "promo_inspect": _sql(f"""select ds, {SERIES}, round(yhat, 6) yhat, round(yhat_lower, 6) yhat_lower, round(yhat_upper, 6) yhat_upper
        from forecast where Shop_SKU in (select Shop_SKU from campaign)
          and ds between (select min(ds) from campaign) and (select max(ds) from campaign)"""),
    "promo_summary": _sql(f"""select {SERIES}, coalesce(promo_flag, 0) = 1 is_promo, round(avg(yhat), 6) avg_yhat,
        round(median(yhat), 6) median_yhat, count(yhat) n_days
        from forecast left join campaign using (ds, Shop_SKU) where Shop_SKU in (select Shop_SKU from campaign) group by all"""),
    "production_window": _sql(f"""select ds, {SERIES}, round(yhat, 6) yhat, round(yhat_lower, 6) yhat_lower, round(yhat_upper, 6) yhat_upper,
        latest_date, case when ds <= latest_date then 'past' else 'future' end segment
        from forecast join latest using (customer_code, warehousecode)
        where ds <= latest_date or ds between date '2001-11-03' and date '2001-11-16'"""),
    "output_shape": _sql("select * from shaped where ds is not null", ("shaped", _SHAPED)),
    "scoped_replace": _sql(
        """select * from old where not exists (select 1 from pairs p where p.customercode = old.customercode
            and p.warehousecode is not distinct from old.warehousecode)
        union all select ds, customercode, nullif(warehousecode, 'None'), Shop_SKU, trunc(yhat)::bigint
        from published join batch using (customercode, warehousecode)""",
        ("published", "select ds, customer_code customercode, warehousecode, Shop_SKU, yhat from forecast"),
        ("old", "select ds, customercode, nullif(warehousecode, 'None') warehousecode, Shop_SKU, cast(-1 as bigint) yhat from published"),
        ("top5", "select customer_code, warehousecode from cleaned group by all order by sum(y) desc, customer_code, warehousecode limit 5"),
        ("batch", """select customer_code customercode, warehousecode from top5 union
            select customer_code, warehousecode from keys where warehousecode = 'None' and customer_code = 'FURNITURE' union
            select customer_code, warehousecode from wanted_pairs"""),
        ("pairs", "select distinct customercode, nullif(warehousecode, 'None') warehousecode from published join batch using (customercode, warehousecode)"),
    ),
    "model_paths": r"""select distinct url sku, case when page_id > 100 then concat('wh ', page_id) end warehouse,
        concat('c_1/', case when page_id > 100 then concat('wh_', page_id) else 'prophet' end, '/',
          regexp_replace(url, '[^\p{L}\p{N}_.\-]', '_', 'g'), '.json') object_path from pages""",
    "model_validation": r"""select id, case when regexp_replace(model_json, '^\s+', '') = '' then 'empty'
          when regexp_replace(model_json, '^\s+', '') like '<%' then 'html'
          when regexp_replace(model_json, '^\s+', '') not like '{%' then 'not json'
          when json_valid(model_json) then 'incomplete' else 'broken json' end state
        from (""" + _input(fx.DOCUMENTS) + ")",
    "structural_fit": _sql(f"""select {SERIES}, cast(null as varchar) error, 'multiplicative' as mode, cast(min(ds) + 7 as varchar) first_ds,
        cast(max(ds) as varchar) last_ds, (count(*) - 7)::int n_rows, true has_sigma, 7 n_weekly, 4 n_regressors, 25 n_changepoints,
        true at_minimum
        from demand join pareto using ({SERIES}) group by all"""),
    "structural_frame": _sql(f"""select f.ds, {SERIES}, coalesce(promo_flag, 0) promo_flag, true in_order from (
          select {SERIES}, unnest(generate_series(first_ds::timestamp + interval 7 day, last_ds::timestamp + interval 14 day, interval 1 day))::date ds
          from spans join pareto using ({SERIES})) f left join campaign using (ds, Shop_SKU)"""),
    "model_index": _sql(f"""select {SERIES}, last_ds,
        concat(customer_code, '/', replace(warehousecode, ' ', '_'), '/', replace(Shop_SKU, '#', '_'), '.json') object_path
        from spans join pareto using ({SERIES})"""),
    "score_frame": _sql(f"""select f.ds, {SERIES}, coalesce(promo_flag, 0) promo_flag, true is_count from (
          select {SERIES}, unnest(generate_series(last_ds::timestamp + interval 1 day, last_ds::timestamp + interval 14 day, interval 1 day))::date ds
          from spans join pareto using ({SERIES})) f left join campaign using (ds, Shop_SKU)"""),
    "model_export": _sql(f"""select {SERIES}, last_ds, '{fx.AS_OF} 06:30:00' trained_at, 'nightly' run_id, 'ok' state, (n_rows - 7)::int n_rows,
        concat(customer_code, '/', replace(warehousecode, ' ', '_'), '/', replace(Shop_SKU, '#', '_'), '.json') object_path
        from spans join pareto using ({SERIES}) join (select {SERIES}, count(*) n_rows from demand group by all) using ({SERIES})"""),
    "newest_models": _sql(f"""select {SERIES}, concat(customer_code, '/', Shop_SKU, '.json') object_path, last_ds, run_id,
        case when state = 'ok' then m end n_rows from models"""),
    "model_rejects": _sql(f"""select {SERIES}, concat(customer_code, '/', Shop_SKU, '.json') object_path, run_id, state reason
        from models where state <> 'ok'"""),
    "structural_forecast": _sql(f"""select ds, {SERIES}, round(yhat, 6) yhat, round(yhat - margin, 6) yhat_lower, round(yhat + margin, 6) yhat_upper,
        promo_flag from predicted"""),
    "score_models": _sql(_SCORED_COUNTS),
    "score_promos": _sql(_SCORED_COUNTS + f" where Shop_SKU in {_LISTED}"),
    "score_promos_by_customer": _sql(_SCORED_COUNTS.replace("from scored", "from scored_by_customer")
        + " join own_listed using (customer_code, Shop_SKU)"),
    "score_status_by_customer": _sql("""select s.customer_code, m.warehousecode, s.Shop_SKU, coalesce(state, 'missing model') status
        from own_listed s left join models m on m.Shop_SKU = s.Shop_SKU and m.customer_code = s.customer_code"""),
    "score_status": _sql(f"""select m.customer_code, m.warehousecode, s.Shop_SKU, coalesce(state, 'missing model') status
        from (select unnest(list_value{_LISTED}) Shop_SKU) s left join models m on m.Shop_SKU = s.Shop_SKU"""),
    "hybrid_forecast": _sql(
        f"""select r.ds, r.customer_code, r.warehousecode, r.Shop_SKU, yhat, yhat_lower, yhat_upper, method,
          case when coalesce(use_promotions, true) then coalesce(c.promo_flag, 0) else 0 end promo_flag,
          case when r.ds <= latest_date then 'past' else 'future' end segment
        from job_rows r join latest using (customer_code, warehousecode) join found_for_demand using (customer_code, warehousecode)
        left join campaign c on c.ds = r.ds and c.Shop_SKU = r.Shop_SKU""", *_job_steps(_JOB_ROUTE)),
    "train_forecast": _sql(
        """select ds::timestamp ds, customer_code customercode, warehousecode, Shop_SKU, yhat, true is_count
        from job_rows join latest using (customer_code, warehousecode) where ds > latest_date""", *_job_steps(_JOB_ROUTE)),
    "customer_forecast": _sql(
        f"""select ds, {SERIES}, method, yhat from job_rows join latest using (customer_code, warehousecode)
        where ds > latest_date and customer_code = 'FURNITURE' and warehousecode in ('ASIA', 'EUROPE')""",
        *_job_steps(f"select {SERIES} from pareto")),
    "hybrid_coverage": _sql(f"""select {SERIES}, cast(14 as bigint) future_days, max(ds) + 14 last_ds, 1 all_non_negative, 1 bounds_in_order,
        cast(max(case when coalesce(use_promotions, true) then coalesce(n, 0) else 0 end) as bigint) promo_days
        from demand join found_for_demand using (customer_code, warehousecode)
        left join (select Shop_SKU, count(*) n from campaign group by all) using (Shop_SKU) group by all"""),
    "pair_status": _sql("""select w.customer_code customercode, w.warehousecode, n is not null ok, false skipped,
        cast(null as varchar) reason, case when n is null then 'no demand' end error, cast(coalesce(n, 0) as bigint) n_rows
        from wanted_pairs w left join (select customer_code, warehousecode, count(*) * 14 n from keys group by all) k
          on k.customer_code = w.customer_code and k.warehousecode = w.warehousecode"""),
    "promo_retrain_status": _sql(f"""select '{fx.SPECIAL}' customer_code, s.Shop_SKU, 14 periods,
        case when k.Shop_SKU is null then 'no demand' else 'uploaded' end status
        from (select unnest(list_value('Brand#3', 'Brand#4', 'Brand#5', 'Brand#6', 'Brand#99')) Shop_SKU) s
        left join (select distinct Shop_SKU from keys where customer_code = '{fx.SPECIAL}') k using (Shop_SKU)"""),
}
