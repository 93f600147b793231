"""Queries for sources, projections, scalar functions and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import scalars as S
from larder.operators import calendar as C
from larder.operators import clean as P
from larder.operators import features as X
from larder.operators import metrics as M
from larder.operators import waste as W
from larder.operators.weather import join_weather
from larder.plans.registry import query
from larder.plans.views import SALE_KEY
from larder.sources.tables import param_columns, weather_rows, with_params

KEY = "ok, ln, sk, xp, product_id"

# ---------------------------------------------------------------- sources


@query(
    "SRC3_weather_rows",
    """select date_trunc('month', dt)::date doc, dt date, tmin temperature_min, tmax temperature_max,
  round((tmin+tmax)/2, 3) temperature_mean, rain rain_mm, 0.25::double snowfall_cm from weather""",
    ("weather",),
)
def src3(v):
    # one document per month (at most 31 days each) written and read back as JSON
    days = F.sort_array(F.collect_list(F.struct("dt", "tmin", "tmax", "rain")))
    months = v.weather.groupBy(F.trunc("dt", "MM").alias("doc")).agg(days.alias("d"))
    arrays = {
        "time": lambda d: F.date_format(d.dt, "yyyy-MM-dd"),
        "temperature_2m_min": lambda d: d.tmin,
        "temperature_2m_max": lambda d: d.tmax,
        "temperature_2m_mean": lambda d: F.round((d.tmin + d.tmax) / 2, 3),
        "rain_sum": lambda d: d.rain,
        "snowfall_sum": lambda d: F.lit(0.25),
    }
    daily = F.struct(*[F.transform("d", f).alias(n) for n, f in arrays.items()])
    docs = months.select("doc", F.to_json(F.struct(daily.alias("daily"))).alias("json"))
    return weather_rows(docs, "json", keep=["doc"])


@query(
    "SRC5_load_calendar",
    """select row_id, event_name, make_date(year(a)+1, month(a), day(a)) start_date,
  case when month(b)=2 and day(b)=29 then make_date(year(a)+1, month(a), day(a)) + 2
    else make_date(case when month(b) < 13 then year(a)+1 end, month(b), day(b)) end end_date,
  case when month(b)=2 and day(b)=29 then 3
    else make_date(year(a)+1, month(b), day(b)) - make_date(year(a)+1, month(a), day(a)) + 1 end duration_days
from (select row_id, trim(event_name) event_name,
    coalesce(try_strptime(st,'%d-%m-%Y'), try_strptime(st,'%d/%m/%Y'))::date a, try_strptime(en,'%d-%m-%Y')::date b from cal_raw)
where a is not null and not (month(a)=2 and day(a)=29)""",
    ("cal_raw",),
)
def src5(v):
    # the year column moves both dates one year on; 29 Feb is lost, then the given duration of 3 counts
    year = F.year(S.parse_date("st")) + 1
    raw = v.cal_raw.select(
        "row_id",
        F.col("event_name").alias("Holidays/Event"),
        F.col("st").alias("Start Date"),
        F.col("en").alias("End Date"),
        year.alias("Year"),
        F.lit("3").alias("Duration (days)"),
    )
    return C.load_calendar(raw, keep=("row_id",), bad_start="drop")


# ---------------------------------------------------------------- projections and filters


@query(
    "P1_slug",
    """select p_partkey product_id, trim(regexp_replace(lower(trim(concat('  ', p_name, ' / ', p_brand, '-', p_type, '!'))),
  '[^0-9a-z]+', '_', 'g'), '_') slug from part""",
)
def p1(v):
    text = F.concat(F.lit("  "), "p_name", F.lit(" / "), "p_brand", F.lit("-"), "p_type", F.lit("!"))
    return v.table("part").select(F.col("p_partkey").alias("product_id"), S.slug(text).alias("slug"))


@query(
    "P3_parse_rates",
    """select round(avg(case when a is not null then 1.0::double else 0 end), 9) st,
  round(avg(case when b is not null then 1.0::double else 0 end), 9) en, 0.0::double event_name
from (select coalesce(try_strptime(st,'%d-%m-%Y'), try_strptime(st,'%d/%m/%Y'))::date a, try_strptime(en,'%d-%m-%Y')::date b from cal_raw)""",
    ("cal_raw",),
)
def p3(v):
    rates = P.parse_rates(v.cal_raw, ["st", "en", "event_name"])
    return rates.select(*[F.round(c, 9).alias(c) for c in rates.columns])


@query(
    "P5_conform",
    f"select product, category, dt, quantity_sold quantity, {KEY} from sales",
    ("sales",),
)
def p5(v):
    renamed = v.sales.withColumnRenamed("quantity_sold", "quantity")
    return P.conform(renamed, ["product", "category", "dt", "waste_flag", "quantity", *SALE_KEY])


@query(
    "P6_exact_columns",
    f"select {KEY}, product, '' customer_type, discount, '' payment from sales",
    ("sales",),
)
def p6(v):
    return P.conform(v.sales, [*SALE_KEY, "product", "customer_type", "discount", "payment"], "blank")


@query(
    "P7_align_features",
    f"select {KEY}, quantity_sold, shelf_life, 0.0::double holiday_1, 0.0::double snowfall_cm from sales",
    ("sales",),
)
def p7(v):
    return P.align(v.sales, [*SALE_KEY, "quantity_sold", "shelf_life", "holiday_1", "snowfall_cm"], 0.0)


@query(
    "P8_drop_undated",
    """select row_id, event_name, a from (select row_id, event_name,
  coalesce(try_strptime(st,'%d-%m-%Y'), try_strptime(st,'%d/%m/%Y'))::date a from cal_raw) where a is not null""",
    ("cal_raw",),
)
def p8(v):
    return P.drop_undated(v.cal_raw.select("row_id", "event_name", S.parse_date("st").alias("a")), "a")


@query("P9_valid_intervals", "select row_id, a start_date, b end_date from cal", ("cal",))
def p9(v):
    raw = v.cal_raw.select("row_id", S.parse_date("st").alias("start_date"), S.parse_date("en").alias("end_date"))
    return P.valid_intervals(raw, "start_date", "end_date")


@query(
    "P10_numeric_target",
    """select event_id, try_cast(t as double) target from (select event_id,
  case when event_type = 'error' then 'n/a' else json_extract_string(props, '$.k') end t from events)
where try_cast(t as double) is not null""",
)
def p10(v):
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.get_json_object("props", "$.k"))
    return P.numeric_target(v.table("events").select("event_id", text.alias("target")), "target")


@query("P11_same_text", "select row_id, event_name from cal_raw where lower(trim(event_name)) = 'high sale'", ("cal_raw",))
def p11(v):
    return M.event_rows(v.cal_raw.select("row_id", "event_name"), "event_name", "  High SALE ")


@query(
    "P12_min_history",
    f"select {KEY}, dt, quantity_sold from moves where product_id in (select product_id from moves group by 1 having count(*) >= 30)",
    ("moves",),
)
def p12(v):
    return P.min_history(v.moves.select(*SALE_KEY, "dt", "quantity_sold"), ["product_id"], 30)


@query(
    "P13_conditional_quantities",
    """select product, category, expiry, total_quantity_sold, waste_quantity, total_quantity_sold - waste_quantity actual_quantity_to_be_sold,
  case when total_quantity_sold - waste_quantity = 0 then total_quantity_sold else total_quantity_sold - waste_quantity end quantity_to_be_sold,
  case when total_quantity_sold - waste_quantity = 0 then 0.0 else waste_quantity end waste_product_quantity
from (select product, category, expiry, cast(sum(cast(quantity_sold as decimal(18,2))) as double) total_quantity_sold,
    nullif(max(quantity_sold), 50) waste_quantity from sales group by 1, 2, 3)""",
    ("sales",),
)
def p13(v):
    rows = v.sales.groupBy("product", "category", "expiry").agg(
        F.sum(F.col("quantity_sold").cast("decimal(18,2)")).cast("double").alias("total_quantity_sold"),
        F.nullif(F.max("quantity_sold"), F.lit(50.0)).alias("waste_quantity"),
    )
    return W.sell_quantities(rows)


@query(
    "P14_fill_missing",
    "select event_id, coalesce(nullif(event_type, 'error'), 'none') event_type, coalesce(nullif(value, 1.0), 0.0) \"value\" from events",
)
def p14(v):
    gaps = v.table("events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type"), F.nullif("value", F.lit(1.0)).alias("value")
    )
    return P.fill_missing(gaps, {"event_type": "none", "value": 0.0})


@query("P15_default_columns", f"select {KEY}, quantity_sold, 30.0::double shelf_life, 0 category_enc from moves", ("moves",))
def p15(v):
    return P.default_columns(v.moves.select(*SALE_KEY, "quantity_sold"), {"shelf_life": 30.0, "category_enc": 0, "xp": 0.0})


@query(
    "P16_param_bounds",
    """select brand, least(greatest(coalesce(test_size, 0.1), 0.05), 0.5) test_size, coalesce(n_estimators, 120) n_estimators,
  coalesce(max_depth, 5) max_depth, 0.01::double learning_rate from params""",
    ("params",),
)
def p16(v):
    filled = v.params.withColumns({c: F.lit(None).cast("double") for c in ("learning_rate", "subsample", "colsample_bytree")})
    return filled.withColumns(param_columns()).select("brand", "test_size", "n_estimators", "max_depth", "learning_rate")


EVENT_CODES = """codes as (select lower(trim(event_name)) event_name, row_number() over (order by lower(trim(event_name))) - 1 code
  from (select distinct lower(trim(event_name)) event_name from cal union select 'none'))"""


@query(
    "P17_event_codes",
    f"""with {EVENT_CODES}, asked as (select row_id, case when month(a) = 3 then concat('New ', event_name) when month(a) = 4 then ' NONE' else event_name end event_name from cal)
select row_id, asked.event_name, lower(trim(asked.event_name)) event_key, coalesce(k.code, n.code) event_code,
  case when k.code is not null and k.event_name = 'none' then 0.0::double else 1.0 end event_flag,
  coalesce(k.event_name, 'none') canonical_name
from asked left join codes k on lower(trim(asked.event_name)) = k.event_name, (select code from codes where event_name = 'none') n""",
    ("cal",),
)
def p17(v):
    names = v.cal.select(F.lower(F.trim("event_name")).alias("event_name"))
    with_none = names.select(F.explode(F.array("event_name", F.lit("none"))).alias("event_name"))
    codes = X.code_table(with_none, "event_name")
    start = F.month("start_date")
    asked = v.cal.select(
        "row_id",
        F.when(start == 3, F.concat(F.lit("New "), "event_name")).when(start == 4, F.lit(" NONE")).otherwise(F.col("event_name")).alias("event_name"),
    )
    return X.event_codes(asked, codes)


# ---------------------------------------------------------------- scalar functions


@query(
    "D1_parse_dates",
    "select row_id, coalesce(try_strptime(st,'%d-%m-%Y'), try_strptime(st,'%d/%m/%Y'))::date parsed, try_strptime(en,'%d-%m-%Y')::date parsed_end from cal_raw",
    ("cal_raw",),
)
def d1(v):
    return v.cal_raw.select("row_id", S.parse_date("st").alias("parsed"), S.parse_date(F.concat(F.lit(" "), "en")).alias("parsed_end"))


@query(
    "D2_date_text",
    "select row_id, coalesce(strftime(coalesce(try_strptime(st,'%d-%m-%Y'), try_strptime(st,'%d/%m/%Y')), '%d-%m-%Y'), trim(st)) shown from cal_raw",
    ("cal_raw",),
)
def d2(v):
    return v.cal_raw.select("row_id", S.date_text(S.parse_date("st"), "st").alias("shown"))


@query(
    "D3_time_parts",
    """select o_orderkey ok, year(d) "year", month(d) "month", day(d) "day", isodow(d)-1 dow, weekofyear(d) weekofyear,
  case when day(d)=1 then 1 else 0 end is_month_start, case when d = last_day(d) then 1 else 0 end is_month_end, quarter(d) "quarter"
from (select o_orderkey, cast(o_orderdate as date) d from orders)""",
)
def d3(v):
    dated = v.orders.select(F.col("o_orderkey").alias("ok"), F.to_date("o_orderdate").alias("d"))
    return X.add_time_parts(dated, "d").drop("d")


@query(
    "D4_date_parts",
    """select o_orderkey ok, isodow(d)-1 dayofweek, month(d) "month", day(d) "day" from (select o_orderkey, cast(o_orderdate as date) d from orders)""",
)
def d4(v):
    dated = v.orders.select(F.col("o_orderkey").alias("ok"), F.to_date("o_orderdate").alias("d"))
    return X.add_date_parts(dated, "d").drop("d")


@query("D5_days_between", f"select {KEY}, expiry - dt remaining_shelf_life from sales", ("sales",))
def d5(v):
    return v.sales.select(*SALE_KEY, S.days_between("expiry", "dt").alias("remaining_shelf_life"))


@query("D6_inclusive_days", "select row_id, b - a + 1 duration_days from cal", ("cal",))
def d6(v):
    return v.cal.select("row_id", S.inclusive_days("start_date", "end_date").alias("duration_days"))


@query(
    "D7_with_year",
    """select o_orderkey ok, case when o_orderpriority = '5-LOW' then d
  when month(d)=2 and day(d)=29 and not (y % 4 = 0 and (y % 100 <> 0 or y % 400 = 0)) then null
  else make_date(y, month(d), day(d)) end moved
from (select o_orderkey, o_orderpriority, cast(o_orderdate as date) d, year(o_orderdate) + 1 + cast(o_custkey % 4 as int) y from orders)""",
)
def d7(v):
    year = F.when(F.col("o_orderpriority") != "5-LOW", F.year("o_orderdate") + 1 + F.col("o_custkey") % 4)
    return v.orders.select(F.col("o_orderkey").alias("ok"), S.with_year(F.to_date("o_orderdate"), year).alias("moved"))


@query("D8_window_end", f"select {KEY}, dt + shelf_life - 1 window_end from sales", ("sales",))
def d8(v):
    return v.sales.select(*SALE_KEY, S.window_end("dt", "shelf_life").alias("window_end"))


@query(
    "D9_percent",
    f"select {KEY}, cast(replace(discount,'%','') as double) pct, cast(replace(discount,'%','') as double)/100 share from sales",
    ("sales",),
)
def d9(v):
    padded = F.concat(F.lit(" "), "discount", F.lit(" "))
    return v.sales.select(*SALE_KEY, S.percent("discount").alias("pct"), S.percent(padded, 100).alias("share"))


@query(
    "D10_number",
    """select event_id, case when event_type = 'click' then null else try_cast(case when event_type = 'error' then 'n/a' else json_extract_string(props,'$.k') end as double) end x from events""",
)
def d10(v):
    text = (
        F.when(F.col("event_type") == "error", "n/a")
        .when(F.col("event_type") == "click", "nan")
        .otherwise(F.concat(F.lit(" "), F.get_json_object("props", "$.k")))
    )
    return v.table("events").select("event_id", S.number(text).alias("x"))


@query(
    "D11_rounding",
    f"""select {KEY}, round_even(quantity_sold/4, 0) half_even, cast(round_even(quantity_sold/2, 0) as int) whole,
  cast(trunc(xp/1000) as int) truncated, round_even(quantity_sold/64, 5) five from moves""",
    ("moves",),
)
def d11(v):
    return v.moves.select(
        *SALE_KEY,
        S.half_even(F.col("quantity_sold") / 4).alias("half_even"),
        S.whole(F.col("quantity_sold") / 2).alias("whole"),
        (F.col("xp") / 1000).cast("int").alias("truncated"),
        S.half_even(F.col("quantity_sold") / 64, 5).alias("five"),
    )


@query(
    "D12_thresholds",
    f"""select {KEY}, case when quantity_sold >= 20 then 1 else 0 end true_class, case when quantity_sold >= 15 then 1 else 0 end pred_class,
  case when quantity_sold - 25 > 0 then 1 else 0 end positive from moves""",
    ("moves",),
)
def d12(v):
    q = F.col("quantity_sold")
    return v.moves.select(
        *SALE_KEY, S.at_least(q, 20).alias("true_class"), S.at_least(q, 15).alias("pred_class"), S.above(q - 25, 0).alias("positive")
    )


@query("D13_clip", f"select {KEY}, least(greatest((quantity_sold-10)/20, 0.0), 1.0) clipped from moves", ("moves",))
def d13(v):
    return v.moves.select(*SALE_KEY, S.clip((F.col("quantity_sold") - 10) / 20).alias("clipped"))


# ---------------------------------------------------------------- joins

SOLD_SQL = """sold as (select s.expiry expiry_date, s.category, s.product, q.total_quantity_sold, s.dt date, s.event, s.holiday, s.shelf_life,
    s.expiry - s.dt remaining_shelf_life
  from (select distinct expiry, category, product, dt, event, holiday, shelf_life from sales) s
  join (select expiry, category, product, cast(sum(cast(quantity_sold as decimal(18,2))) as double) total_quantity_sold from sales group by 1,2,3) q
  using (expiry, category, product))"""


@query(
    "J1_waste_table",
    f"""with {SOLD_SQL} select product, category, expiry_date, shelf_life, remaining_shelf_life, k.quantity total_quantity,
  k.quantity - total_quantity_sold waste_product_quantity, event, holiday, date
from sold left join (select product, category, expiry expiry_date, quantity from stock) k using (product, category, expiry_date)""",
    ("sales", "stock"),
)
def j1(v):
    return W.waste_table(W.sold_by_expiry(v.canonical), v.stock.withColumnRenamed("expiry", "expiry_date"))


@query(
    "J1_waste_table_legacy",
    f"""with {SOLD_SQL} select product, category, expiry_date, shelf_life, remaining_shelf_life, total_quantity_sold total_quantity,
  case when total_quantity_sold - coalesce(k.quantity, 0) = 0 then 0.0 else coalesce(k.quantity, 0) end waste_product_quantity, event, holiday, date
from sold left join (select product, category, expiry expiry_date, quantity from stock) k using (product, category, expiry_date)""",
    ("sales", "stock"),
)
def j1_legacy(v):
    return W.waste_table(W.sold_by_expiry(v.canonical), v.stock.withColumnRenamed("expiry", "expiry_date"), "legacy")


@query(
    "J2_join_weather",
    f"""select {KEY}, m.dt, quantity_sold, tmin, tmax, rain from moves m left join weather w on m.dt is not distinct from w.dt""",
    ("moves", "weather"),
)
def j2(v):
    sales = v.moves.select(*SALE_KEY, "dt", "quantity_sold", F.lit("card").alias("payment"))
    return join_weather(sales, v.weather, "dt")


J3_SQL = f"select {KEY}, dt, quantity_sold, event_name from moves join cal on dt between a and b"


@query("J3_join_calendar", J3_SQL, ("moves", "cal"))
def j3(v):
    return C.join_calendar(v.moves.select(*SALE_KEY, "dt", "quantity_sold"), v.cal.drop("row_id", "duration_days"), "dt")


@query("J3b_join_calendar_interval", J3_SQL, ("moves", "cal"))
def j3b(v):
    return C.join_calendar_interval(v.moves.select(*SALE_KEY, "dt", "quantity_sold"), v.cal, "dt")


@query(
    "J3c_sales_with_events",
    """select strftime(dt, '%d-%m-%Y') date, s.product_id, product, category, quantity_sold, strftime(expiry, '%d-%m-%Y') expiry_date,
  unit_price, discount, discount_price, '' shelf_life, holiday, event, concat(' ', event_name, ' ') event_name
from sales s join cal on dt between a and b""",
    ("sales", "cal"),
)
def j3c(v):
    # raw tables with other header spellings; shelf life is absent and comes out blank
    raw = v.sales.select(
        F.date_format("dt", "d/M/yyyy").alias("Sales Date"), F.col("product_id").alias("Product-ID"), "product", "category",
        F.col("quantity_sold").alias(" Quantity Sold"), F.col("expiry").cast("string").alias("Exp Date"), "unit_price",
        "discount", "discount_price", "holiday", "event",
    )
    events = v.cal_raw.select(
        F.col("event_name").alias("Event Name"), F.col("st").alias("Start Date"), F.col("en").alias("End Date")
    )
    return C.sales_with_events(raw, events)


@query("J4_sold_by_expiry", f"with {SOLD_SQL} select * from sold", ("sales",))
def j4(v):
    return W.sold_by_expiry(v.canonical)


WINDOW_ROWS = """select product_id, event_name, row_id, a + cast(i as int) date, q.quantity_sold
from (select row_id, event_name, a, b, unnest(generate_series(0, b - a)) i from cal) d
join (select dt, product_id, cast(sum(cast(quantity_sold as decimal(18,2))) as double) quantity_sold from moves group by 1, 2) q on q.dt = d.a + cast(d.i as int)"""


@query(
    "J5_window_totals",
    f"""with r as ({WINDOW_ROWS}) select *, sum(quantity_sold) over (partition by product_id, row_id) window_total from r""",
    ("moves", "cal"),
)
def j5(v):
    # rows per product and occurrence number at most the days of the occurrence, so the window is small
    daily = v.moves.groupBy("dt", "product_id").agg(F.sum("quantity_sold").alias("quantity_sold"))
    days = C.event_days(v.cal, day="date").select("row_id", "event_name", "date")
    rows = daily.join(days, F.col("dt") == F.col("date")).drop("dt")
    from larder.plans.forecast import with_window_total

    return with_window_total(rows, ["product_id", "row_id"], "quantity_sold", "window_total")


@query(
    "J7_params",
    f"""select {KEY}, s.brand, least(greatest(coalesce(test_size, 0.1), 0.05), 0.5) test_size, coalesce(n_estimators, 120) n_estimators,
  coalesce(max_depth, 5) max_depth, 0.6::double subsample from sales s left join params p on s.brand = p.brand""",
    ("sales", "params"),
)
def j7(v):
    return with_params(v.sales.select(*SALE_KEY, "brand"), v.params, "brand").select(
        *SALE_KEY, "brand", "test_size", "n_estimators", "max_depth", "subsample"
    )


@query(
    "J8_code_names",
    f"""with k as (select category, row_number() over (order by category) - 1 code from (select distinct category from sales))
select {KEY}, code, k.category category from sales s join k on s.category = k.category""",
    ("sales",),
)
def j8(v):
    names = X.code_table(v.sales, "category")
    coded = X.label_codes(v.sales.select(*SALE_KEY, "category"), "category", "code").drop("category")
    return coded.join(names, "code")


@query(
    "J9_future_frame",
    f"""with l as (select product_id, arg_max(xp, (dt, ok, ln, sk, xp)) unit_price from moves group by 1)
select product_id, unit_price, date '2001-08-01' + cast(i as int) date, isodow(date '2001-08-01' + cast(i as int)) - 1 dayofweek,
  month(date '2001-08-01' + cast(i as int)) "month", day(date '2001-08-01' + cast(i as int)) "day"
from l, generate_series(1, 10) g(i)""",
    ("moves",),
)
def j9(v):
    from larder.plans.forecast import future_frame

    last = X.last_known(
        v.moves.select(*SALE_KEY, "dt", F.col("xp").alias("unit_price")), ["product_id"], ["dt", "ok", "ln", "sk", "xp"], ["unit_price"]
    )
    return future_frame(last, "2001-08-01", 10)
