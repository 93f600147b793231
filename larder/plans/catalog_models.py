"""Queries that fit models. Tree counts are small parameters here; the published sizes are in
``operators.models``. Model output has no SQL form, so most of these are checked by their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import scalars as S
from larder.operators import calendar as C
from larder.operators import features as X
from larder.operators import models as D
from larder.operators import splits as T
from larder.operators import waste as W
from larder.plans import forecast as B
from larder.plans import jobs as J
from larder.plans.catalog_series import METRICS_SQL, ORDER, ORDER_SQL, rounded
from larder.plans.registry import query
from larder.plans.views import SALE_KEY, canonical, stock
from larder.session import forget, materialize
from larder.sources.tables import DEFAULT_PARAMS

TREES = D.ModelSpec("gbt", trees=5, depth=4, learning_rate=0.3, subsample=0.8, colsample=0.8)
FOREST = D.ModelSpec("forest", trees=8, depth=6, min_leaf=2)
NUMERIC = ["shelf_life", "unit_price", "disc", "dow", "month"]
NEXT_DAY = "2001-08-01"
# fewer and shallower trees than the published defaults
SMALL = {"test_size": 0.1, "n_estimators": 5, "learning_rate": 0.1, "max_depth": 3, "subsample": 0.6, "colsample_bytree": 0.9}


def model_rows(v) -> DataFrame:
    return T.hash_split(v.sales.withColumns(S.time_parts("dt")), ["ok", "ln", "sk", "product_id"], 0.2)


def fit_and_score(v, spec: D.ModelSpec) -> DataFrame:
    rows = model_rows(v)
    model = D.fit(rows.filter("split = 'train'"), spec, "quantity_sold", NUMERIC, ["category"], scale=True)
    return D.score(model, rows.filter("split = 'test'")).select(*SALE_KEY, "quantity_sold", "prediction")


@query("M1_boosted_trees")
def m1(v):
    return fit_and_score(v, TREES)


@query("M2_random_forest")
def m2(v):
    return fit_and_score(v, FOREST)


@query("M3_linear_regression")
def m3(v):
    return fit_and_score(v, D.LINEAR)


@query(
    "M3b_trend_per_product",
    """select product_id, round(regr_slope(quantity_sold, dt - date '1995-01-01'), 9) + 0.0 slope,
  round(regr_intercept(quantity_sold, dt - date '1995-01-01'), 9) intercept, round(regr_r2(quantity_sold, dt - date '1995-01-01'), 9) fit_r2 from moves group by 1""",
    ("moves",),
)
def m3b(v):
    day = S.days_between("dt", F.lit("1995-01-01").cast("date")).cast("double")
    line = D.trend(v.moves.withColumn("x", day), ["product_id"], "x", "quantity_sold")
    return rounded(line, "slope", "intercept", "fit_r2", digits=9)


def brand_params(v) -> DataFrame:
    return v.params.withColumnRenamed("brand", "product_id").withColumn("n_estimators", F.lit(4))


def forecast_input(v) -> DataFrame:
    return v.brand_sales.withColumn("discount", S.percent("discount", 100))


@query("M4_product_forecast")
def m4(v):
    order = ["date", "ok", "ln", "sk", "xp"]
    return B.forecast_products(forecast_input(v), brand_params(v), NEXT_DAY, 10, order, defaults=SMALL)


@query("M4c_forecast_every_product")
def m4c(v):
    """A model of the published size for each product, with the parameters of its brand where these ask for no less."""
    sales = v.canonical.withColumn("discount", S.percent("discount", 100))
    brands = v.table("part").select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("brand"))
    sizes = {c: F.greatest(c, F.lit(DEFAULT_PARAMS[c])) for c in ("n_estimators", "max_depth")}
    params = brands.join(v.params, "brand").drop("brand").withColumns(sizes)
    return B.forecast_products(sales, params, NEXT_DAY, 10, ["date", "ok", "ln", "sk", "xp"], defaults=DEFAULT_PARAMS)


@query(
    "M4t_trend_forecast",
    f"""with r as (select *, row_number() over (partition by product_id order by {ORDER_SQL}) r, count(*) over (partition by product_id) n from moves),
s as (select *, r > n - ceil(n * 0.1::double - 1e-9) test, dt - date '1970-01-01' x from r),
l as (select product_id, regr_slope(quantity_sold, x) filter (where not test) b, regr_intercept(quantity_sold, x) filter (where not test) a from s group by 1),
t as (select product_id, quantity_sold y, a + b*x p from s join l using (product_id) where test),
m as (select product_id, {METRICS_SQL} from t group by 1)
select date '{NEXT_DAY}' + cast(i as int) date, product_id, round(a + b*(date '{NEXT_DAY}' + cast(i as int) - date '1970-01-01'), 6) forecast_quantity, "MAE", "RMSE", "R2", "MAPE"
from l join m using (product_id), generate_series(1, 10) g(i)""".replace(", 9)", ", 6)"),
    ("moves",),
)
def m4t(v):
    rows = v.moves.select(*SALE_KEY, "dt", "quantity_sold")
    out = B.trend_forecast(rows, NEXT_DAY, 10, ORDER)
    return rounded(out, "forecast_quantity", *B.REGRESSION)


def event_sales(v, cal: DataFrame) -> DataFrame:
    """Sales on event days under the library's names, the brand as product."""
    return C.join_calendar(forecast_input(v), cal.select("event_name", "start_date", "end_date"), "date")


@query("M5_event_forecast")
def m5(v):
    order = ["date", "ok", "ln", "sk", "xp", "event_name"]
    cal = materialize(v.cal)
    out = B.forecast_event(event_sales(v, cal), cal, "HIGH Sale", brand_params(v), order, defaults=SMALL)
    return out["forecast"]


FRAME_SQL = """codes as (select event_name, row_number() over (order by event_name) - 1 code from (select distinct lower(event_name) event_name from cal)),
l as (select brand product_id, arg_max(shelf_life, (dt, ok, ln, sk, xp, product_id)) shelf_life from sales group by 1)"""


@query(
    "M5b_event_frame",
    f"""with {FRAME_SQL}, w as (select a window_start, b window_end, row_number() over (order by a, row_id) window_index from cal where event_name = 'HIGH Sale'),
d as (select *, unnest(generate_series(window_start::timestamp, window_end::timestamp, interval 1 day))::date date from w)
select product_id, shelf_life, window_index, window_start, window_end, date, isodow(date)-1 dayofweek, month(date) "month", day(date) "day", 'high sale' event_name,
  (select code from codes where event_name = 'high sale') event_name_enc, 1.0::double event, 0.0::double holiday from l cross join d""",
    ("sales", "cal"),
)
def m5b(v):
    codes = X.code_table(v.cal.select(F.lower("event_name").alias("event_name")), "event_name")
    sales = v.sales.withColumnsRenamed({"product_id": "part_id", "brand": "product_id"})
    last = X.last_known(sales, ["product_id"], ["dt", "ok", "ln", "sk", "xp", "part_id"], ["shelf_life"])
    return B.event_frame(last, v.cal, "high sale", codes)


@query(
    "M5c_event_frame_manual",
    f"""with {FRAME_SQL}, k as (select dur from cal where event_name = 'LOW Sale' group by 1 order by count(*) desc, dur limit 1),
d as (select date '2001-12-24' window_start, date '2001-12-24' + cast(dur as int) - 1 window_end, unnest(generate_series(0, dur - 1)) i from k)
select product_id, shelf_life, 1 window_index, window_start, window_end, window_start + cast(i as int) date, isodow(window_start + cast(i as int))-1 dayofweek,
  month(window_start + cast(i as int)) "month", day(window_start + cast(i as int)) "day", 'LOW Sale' event_name,
  (select code from codes where event_name = 'low sale') event_name_enc, 1.0::double event, 0.0::double holiday from l cross join d""",
    ("sales", "cal"),
)
def m5c(v):
    codes = X.code_table(v.cal.select(F.lower("event_name").alias("event_name")), "event_name")
    sales = v.sales.withColumnsRenamed({"product_id": "part_id", "brand": "product_id"})
    last = X.last_known(sales, ["product_id"], ["dt", "ok", "ln", "sk", "xp", "part_id"], ["shelf_life"])
    return B.event_frame(last, v.cal, "LOW Sale", codes, manual_start="2001-12-24")


@query(
    "M6_metric_summary",
    f"""with m as (select product_id, count(*) n, {METRICS_SQL} from scored group by 1)
select product_id, case when n >= 30 then 'HIGH Sale' end event_name, case when n >= 30 then "MAE" end "MAE", case when n >= 30 then "RMSE" end "RMSE",
  case when n >= 30 then "R2" end "R2", case when n >= 30 then "MAPE" end "MAPE",
  case when n < 30 then concat('Not enough history (<30 rows) for product_id=''', product_id, '''.') end error,
  case when n < 30 then 'HIGH Sale' end event_name_requested from m""",
    ("scored",),
)
def m6(v):
    from larder.operators.clean import min_history
    from larder.operators.metrics import REGRESSION, regression_metrics

    metrics = regression_metrics(min_history(v.scored, ["product_id"], 30), "y", "p", ["product_id"])
    errors = B.short_history_errors(v.scored, "HIGH Sale", n=30)
    return rounded(B.metric_summary(metrics, errors, "HIGH Sale"), *REGRESSION, digits=9)


@query("M6b_event_forecast_metrics")
def m6b(v):
    order = ["date", "ok", "ln", "sk", "xp", "event_name"]
    cal = materialize(v.cal)
    return B.forecast_event(event_sales(v, cal), cal, "HIGH Sale", brand_params(v), order, defaults=SMALL)["metrics"]


@query("M7_feature_importance")
def m7(v):
    rows = model_rows(v)
    model = D.fit(rows, FOREST, "quantity_sold", NUMERIC, ["category"], scale=True)
    return D.importances(model, rows)


@query("M8_residual_table")
def m8(v):
    from larder.operators.metrics import residuals

    return residuals(fit_and_score(v, D.LINEAR), "quantity_sold", "prediction")


# ---------------------------------------------------------------- jobs


def waste_input(v, sales: DataFrame | None = None) -> DataFrame:
    sales = v.sales if sales is None else sales
    return W.waste_table(W.sold_by_expiry(canonical(sales)), stock(sales).withColumnRenamed("expiry", "expiry_date"))


WASTE_COLUMNS = ("dt", "product", "category", "expiry", "quantity_sold", "event", "holiday", "shelf_life", "priority")
WASTE_KEY = ("product", "category", "expiry_date", "date", "shelf_life", "holiday", "event")
WASTE_DROP = ("expiry_date", "row_no")


def waste_series(v) -> DataFrame:
    """The waste table with an integer tie-break for its series. Sales are joined once for what was sold and for the
    stock, and the table is written once for all that read it."""
    sales = materialize(v.sales.select(*WASTE_COLUMNS))
    made = materialize(waste_input(v, sales).withColumn("row_no", F.xxhash64(*WASTE_KEY)))
    forget(sales)
    return made


def trained_waste(rows: DataFrame):
    return J.train_waste(
        rows, {"gbt": TREES}, WASTE_KEY, ids=["product", "category"], order=["date", "row_no"], drop=WASTE_DROP
    )


@query("C8_cross_validate")
def c8(v):
    folded = T.time_series_blocks(model_rows(v), [*ORDER, "product_id"], 2)
    return D.cross_validate(folded, {"linear": D.LINEAR, "gbt": TREES}, "quantity_sold", NUMERIC, ["category"], "block")


def trained_discount(v):
    sales = v.canonical.withColumn("discount", S.percent("discount"))
    return sales, J.train_discount(sales, {"forest": FOREST, "gbt": TREES}, ["ok", "ln", "sk", "product_id"])


@query("ML1_score_discount")
def ml1(v):
    sales, (models, _) = trained_discount(v)
    rows = sales.filter(F.col("date") >= F.lit("2001-07-01").cast("date")).select(
        *SALE_KEY, "date", "product", "category", "expiry_date", "shelf_life", "holiday", "event"
    )
    return J.score_discount(models["gbt"], rows)


@query("ML2_score_waste")
def ml2(v):
    rows = waste_series(v)
    trained = trained_waste(rows)
    start = F.lit("2001-01-01").cast("date")
    history, future = rows.filter(F.col("date") < start), rows.filter(F.col("date") >= start).drop("waste_product_quantity")
    return J.score_waste(trained["models"]["gbt"], future, trained["schema"], history, ["date", "row_no"])


def weather_input(v) -> DataFrame:
    weather = v.weather.select(
        F.col("dt").alias("date"), F.col("tmin").alias("temperature_min"), F.col("tmax").alias("temperature_max"),
        ((F.col("tmin") + F.col("tmax")) / 2).alias("temperature_mean"), F.col("rain").alias("rain_mm"), F.lit(0.0).alias("snowfall_cm"),
    )
    from larder.operators.weather import join_weather

    sales = v.canonical.withColumns({"discount": S.percent("discount"), "total": F.col("xp")})
    return join_weather(sales, weather, "date")


def trained_weather(v):
    return J.train_weather(weather_input(v), {"forest": FOREST, "linear": D.LINEAR}, ["ok", "ln", "sk", "product_id"])


@query("ML3_score_weather_outlook")
def ml3(v):
    trained = trained_weather(v)
    # the last five days with weather serve as the outlook for every product
    latest = v.weather.orderBy(F.desc("dt")).limit(5).select(
        F.col("dt").alias("date"), F.col("tmin").alias("temperature_min"), F.col("tmax").alias("temperature_max"),
        ((F.col("tmin") + F.col("tmax")) / 2).alias("temperature_mean"), F.col("rain").alias("rain_mm"), F.lit(0.0).alias("snowfall_cm"),
    )
    attributes = ["unit_price", "discount", "discount_price", "shelf_life", "holiday", "event"]
    sales = v.canonical.withColumn("discount", S.percent("discount"))
    last = X.last_known(sales, ["product_id"], ["date", "ok", "ln", "sk", "xp"], attributes)
    return J.score_weather(trained["models"]["forest"], last.withColumn("total", F.lit(20.0)), latest, trained)


@query("ML4_train_discount")
def ml4(v):
    return trained_discount(v)[1][1]


@query("ML5_train_waste")
def ml5(v):
    trained = trained_waste(waste_series(v))
    folds = J.metric_rows(trained["cv"].drop("error"), ["model", "fold"]).select(
        "model", F.concat(F.lit("fold_"), "fold").alias("part"), "metric", "value"
    )
    return folds.unionByName(trained["metrics"].select("model", F.lit("holdout").alias("part"), "metric", "value"))


@query("ML6_train_weather")
def ml6(v):
    return trained_weather(v)["metrics"]


