"""Queries that write and read back: tables, parameter files, metric documents, hold-out sets and saved models.

Each writes into a folder of its own below the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import scalars as S
from larder.operators import clean as C
from larder.operators import features as X
from larder.operators import linear as L
from larder.operators import metrics as M
from larder.operators import splits as T
from larder.operators.clean import numeric_target
from larder.plans import jobs as J
from larder.plans.catalog_linear import moments_sql, solve_sql
from larder.plans.catalog_models import waste_input, weather_input
from larder.plans.catalog_series import HASH, HASHED, METRICS_SQL, ROW_HASH, WORD, keyed, rounded
from larder.plans.catalog_tables import SOLD_SQL
from larder.plans.registry import query
from larder.plans.views import SALE_KEY
from larder.session import checkpoint_dir
from larder.sources import sinks
from larder.sources import tables as R


def folder(v) -> str:
    return f"{checkpoint_dir(v.spark).rstrip('/')}/larder-files-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- tables

CSV_COLUMNS = ("ok", "ln", "sk", "product_id", "discount", "brand")


@query(
    "SRC1_csv_with_broken_lines",
    """select ok, ln, sk, product_id, discount, case when ln <> 6 then brand end brand, ln in (5, 6) broken from sales""",
    ("sales",),
)
def src1(v):
    """Sales as CSV, some lines a field too long and some a field too short; both are read and told apart."""
    path = folder(v)
    sales = v.sales.select(*CSV_COLUMNS)
    sinks.write_table(sales.where("ln not in (5, 6)"), path, "csv")
    for line, odd in ((5, sales.withColumn("more", F.lit("x"))), (6, sales.drop("brand"))):
        odd.where(F.col("ln") == line).write.mode("append").option("header", True).csv(path)
    read = R.read_table(v.spark, path, CSV_COLUMNS, corrupt="_line")
    kinds = dict(sales.dtypes)
    return read.select(*[F.col(c).cast(kinds[c]).alias(c) for c in CSV_COLUMNS], F.col("_line").isNotNull().alias("broken"))


@query(
    "SNK1_replace_one_partition",
    """select ok, ln, sk, product_id, quantity_sold, brand from sales where brand <> 'Brand#11'
union all select ok, ln, sk, product_id, quantity_sold + 100, brand from sales where brand = 'Brand#11' and ln <= 3""",
    ("sales",),
)
def snk1(v):
    """All brands, then one brand again: its old rows go, all other partitions stay."""
    path, rows = folder(v), v.sales.select("ok", "ln", "sk", "product_id", "quantity_sold", "brand")
    sinks.replace_partitions(rows, path, ["brand"])
    again = rows.where("brand = 'Brand#11' and ln <= 3").withColumn("quantity_sold", F.col("quantity_sold") + 100)
    sinks.replace_partitions(again, path, ["brand"])
    return sinks.read_committed(v.spark, path).select(rows.columns)


@query(
    "SNK2_metric_document",
    f"""with m as (select model, {METRICS_SQL} from scored group by 1)
select model, metric, value from m unpivot include nulls (value for metric in ("MAE", "RMSE", "R2", "MAPE"))""",
    ("scored",),
)
def snk2(v):
    path = folder(v)
    wide = rounded(M.regression_metrics(v.scored, "y", "p", ["model"]).drop("n"), *M.REGRESSION, digits=9)
    sinks.write_metrics(J.metric_rows(wide, ["model"]), path)
    return sinks.read_metrics(v.spark, path, "model string, metric string, value double")


@query(
    "SNK4_saved_hold_out",
    f"select ok, ln, sk, xp, product_id, quantity_sold from moves where {WORD.format(h=ROW_HASH)}/4294967296.0::double < 0.2",
    ("moves",),
)
def snk4(v):
    path, split = folder(v), T.hash_split(keyed(v), HASHED, 0.2)
    sinks.write_split(split, path)
    return sinks.read_split(v.spark, path, "test", schema=split.schema).select(*SALE_KEY, "quantity_sold")


# ---------------------------------------------------------------- parameter files


def parameter_lists(products: DataFrame, path: str) -> None:
    """JSON lists with an entry for each third product and a second, later one for some of them."""
    share = F.concat(F.lit("0.1"), (F.col("p_partkey") % 7).cast("string"))
    first = F.concat(F.lit('{"product_id": "'), F.col("p_partkey"), F.lit('",\n "tran_parameter": {"test_size": 0.9, "estimators": 10, "subsample": 0.5}}'))
    second = F.concat(
        F.lit(',\n{"product_id": "'), F.col("p_partkey"), F.lit('", "tran_parameter": {"estimators": '), F.col("p_partkey") % 11 + 5,
        F.lit(', "max_depth": 3, "test_size": '), share, F.lit('}, "note": "later"}'),
    )
    entries = products.where("p_partkey % 3 = 0").select(F.concat(first, F.when(F.col("p_partkey") % 2 == 0, second).otherwise("")).alias("value"))

    def lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = "["
        for batch in batches:
            for value in batch["value"]:
                yield pd.DataFrame({"value": [before + value]})
                before = ", "
        yield pd.DataFrame({"value": ["[]" if before == "[" else "]"]})

    entries.mapInPandas(lists, "value string").write.text(path)


@query(
    "SRC2_parameter_file",
    """select p_partkey::varchar product_id, case when listed and p_partkey % 2 = 0 then ('0.1' || (p_partkey % 7))::double when listed then 0.5::double else 0.1::double end test_size,
  case when listed and p_partkey % 2 = 0 then p_partkey % 11 + 5 when listed then 10 else 120 end::int n_estimators, 0.01::double learning_rate,
  case when listed and p_partkey % 2 = 0 then 3 else 5 end::int max_depth, case when listed and p_partkey % 2 = 1 then 0.5 else 0.6 end::double subsample, 0.9::double colsample_bytree
from (select *, p_partkey % 3 = 0 listed from part)""",
)
def src2(v):
    """Parameters of all products: the last entry of the file, held inside its bounds, defaults for the rest."""
    path, products = folder(v), v.table("part").select("p_partkey")
    parameter_lists(products, path)
    keys = products.select(F.col("p_partkey").cast("string").alias("product_id"))
    out = R.with_params(keys, R.read_params(v.spark, path))
    return out.select("product_id", *R.DEFAULT_PARAMS)


@query(
    "SRC2b_parameter_file_absent",
    "select p_partkey::varchar product_id, 0.1::double test_size, 120 n_estimators, 0.01::double learning_rate, 5 max_depth, 0.6::double subsample, 0.9::double colsample_bytree from part",
)
def src2b(v):
    keys = v.table("part").select(F.col("p_partkey").cast("string").alias("product_id"))
    return R.with_params(keys, R.read_params(v.spark, folder(v))).select("product_id", *R.DEFAULT_PARAMS)


# ---------------------------------------------------------------- saved models


def fit_sql(rows: str, train: str, features: tuple[str, ...], target: str) -> str:
    """``base`` (the rows, with the columns of the name given), ``mom`` and the solved plane as ``es``."""
    columns = [*features, target]
    known = " and ".join(f'"{c}" is not null' for c in columns)
    steps, _ = solve_sql("mom", columns, features, "e", "one")
    return f"base as materialized ({rows}),\nmom as ({moments_sql(f'(select * from base where {train} and {known})', columns, '1 one')}),\n{steps}"


def plane(features: tuple[str, ...]) -> str:
    return "a + " + " + ".join(f'b{p} * "{c}"' for p, c in enumerate(features))


def kept_model(v, train: DataFrame, features: tuple[str, ...], target: str, rows: DataFrame) -> L.Linear:
    """Fitted, saved, and loaded again for the rows to be scored."""
    path = folder(v)
    sinks.save_linear(L.fit_linear(train, features, target), train, path, target)
    return sinks.load_linear(v.spark, path, rows)


def metrics_of(model: L.Linear, test: DataFrame, target: str) -> DataFrame:
    return rounded(M.regression_metrics(L.score_linear(model, test), target, "prediction"), *M.REGRESSION, digits=6)


METRICS6 = METRICS_SQL.replace(", 9)", ", 6)")
DISCOUNT = ("shelf_life", "day_of_week", "month", "holiday", "event")
KEY_WORD = WORD.format(h=HASH.format(k="concat_ws('|', ok, ln, sk, product_id)"))
DISCOUNT_SQL = "with " + fit_sql(
    f"select *, round(disc * 100)::double discount_pct, isodow(dt) - 1 day_of_week, month(dt) \"month\", {KEY_WORD} / 4294967296.0::double u from sales",
    "u >= 0.2", DISCOUNT, "discount_pct",
)


def discount_sides(v) -> tuple[DataFrame, DataFrame]:
    sales = J.discount_features(v.canonical.withColumn("discount_pct", S.percent("discount")))
    rows = T.hash_split(numeric_target(sales, "discount_pct"), ["ok", "ln", "sk", "product_id"], 0.2)
    return rows.where("split = 'train'"), rows.where("split = 'test'")


@query(
    "ML1b_score_discount_linear",
    DISCOUNT_SQL + f"\nselect ok, ln, sk, xp, product_id, round({plane(DISCOUNT)}, 6) predicted_discount from base, es where dt >= date '2001-07-01'",
    ("sales",),
)
def ml1b(v):
    train, _ = discount_sides(v)
    rows = J.discount_features(v.canonical.where(F.col("date") >= F.lit("2001-07-01").cast("date")).drop("discount"))
    model = kept_model(v, train, DISCOUNT, "discount_pct", rows)
    return rounded(L.score_linear(model, rows, "predicted_discount").select(*SALE_KEY, "predicted_discount"), "predicted_discount")


@query(
    "ML4b_train_discount_linear",
    DISCOUNT_SQL + f'\nselect count(*) n, {METRICS6} from (select discount_pct y, {plane(DISCOUNT)} p from base, es where u < 0.2)',
    ("sales",),
)
def ml4b(v):
    train, test = discount_sides(v)
    return metrics_of(kept_model(v, train, DISCOUNT, "discount_pct", test), test, "discount_pct")


WASTE = ("total_quantity", "shelf_life", "month", "dow")
WASTE_ROWS_SQL = """select *, month(date) "month", isodow(date) - 1 dow from (select product, category, expiry_date, shelf_life, k.quantity total_quantity,
  k.quantity - total_quantity_sold waste_product_quantity, event, holiday, date
from sold left join (select product, category, expiry expiry_date, quantity from stock) k using (product, category, expiry_date))"""
WASTE_SQL = f"with {SOLD_SQL},\n" + fit_sql(WASTE_ROWS_SQL, "date < date '2001-01-01'", WASTE, "waste_product_quantity")


def waste_sides(v) -> tuple[DataFrame, DataFrame]:
    rows = waste_input(v).withColumns({"month": F.month("date"), "dow": F.weekday("date")})
    start = F.lit("2001-01-01").cast("date")
    return numeric_target(rows.where(F.col("date") < start), "waste_product_quantity"), rows.where(F.col("date") >= start)


@query(
    "ML2b_score_waste_linear",
    WASTE_SQL + f"\nselect product, category, expiry_date, date, shelf_life, holiday, event, round({plane(WASTE)}, 6) predicted_wastage from base, es where date >= date '2001-01-01'",
    ("sales", "stock"),
)
def ml2b(v):
    train, rows = waste_sides(v)
    model = kept_model(v, train, WASTE, "waste_product_quantity", rows.drop("waste_product_quantity"))
    out = L.score_linear(model, rows, "predicted_wastage")
    return rounded(out.select("product", "category", "expiry_date", "date", "shelf_life", "holiday", "event", "predicted_wastage"), "predicted_wastage")


@query(
    "ML5b_train_waste_linear",
    WASTE_SQL + f"""\nselect count(*) n, {METRICS6} from (select waste_product_quantity y, {plane(WASTE)} p from base, es where date >= date '2001-01-01')
where y is not null and p is not null""",
    ("sales", "stock"),
)
def ml5b(v):
    train, test = waste_sides(v)
    return metrics_of(kept_model(v, train, WASTE, "waste_product_quantity", test), test, "waste_product_quantity")


WEATHER = ("unit_price", "discount", "temperature_min", "temperature_max", "rain_mm", "month", "dayofweek")
WEATHER_SQL = "with " + fit_sql(
    f"""select s.* exclude (discount), round(disc * 100)::double discount, tmin temperature_min, tmax temperature_max, rain rain_mm, month(s.dt) "month", isodow(s.dt) - 1 dayofweek,
  {KEY_WORD} / 4294967296.0::double u from sales s left join weather w on w.dt is not distinct from s.dt""",
    "u >= 0.5", WEATHER, "quantity_sold",
)


def weather_sides(v) -> tuple[DataFrame, DataFrame]:
    rows = T.hash_split(numeric_target(J.weather_features(weather_input(v)), "quantity_sold"), ["ok", "ln", "sk", "product_id"], 0.5)
    return rows.where("split = 'train'"), rows.where("split = 'test'")


@query(
    "ML3b_score_weather_linear",
    WEATHER_SQL + f""",
l as (select product_id, arg_max(unit_price, (dt, ok, ln, sk, xp)) unit_price, arg_max(round(disc * 100)::double, (dt, ok, ln, sk, xp)) discount from sales group by 1),
o as (select dt date, tmin temperature_min, tmax temperature_max, rain rain_mm, month(dt) "month", isodow(dt) - 1 dayofweek from weather order by dt desc limit 5)
select product_id, date, round({plane(WEATHER)}, 6) predicted_quantity from l, o, es""",
    ("sales", "weather"),
)
def ml3b(v):
    train, _ = weather_sides(v)
    days = v.weather.orderBy(F.desc("dt")).limit(5).select(
        F.col("dt").alias("date"), F.col("tmin").alias("temperature_min"), F.col("tmax").alias("temperature_max"), F.col("rain").alias("rain_mm")
    )
    sales = v.canonical.withColumn("discount", S.percent("discount"))
    last = X.last_known(sales, ["product_id"], ["date", "ok", "ln", "sk", "xp"], ["unit_price", "discount"])
    outlook = days.agg(F.array_sort(F.collect_list(F.struct(*days.columns))).alias("w")).scalar()
    rows = last.select("*", F.inline(outlook)).withColumns(S.date_parts("date"))
    model = kept_model(v, train, WEATHER, "quantity_sold", rows)
    return rounded(L.score_linear(model, rows, "predicted_quantity").select("product_id", "date", "predicted_quantity"), "predicted_quantity")


@query(
    "ML6b_train_weather_linear",
    WEATHER_SQL + f"""\nselect count(*) n, {METRICS6} from (select quantity_sold y, {plane(WEATHER)} p from base, es where u < 0.5) where p is not null""",
    ("sales", "weather"),
)
def ml6b(v):
    train, test = weather_sides(v)
    return metrics_of(kept_model(v, train, WEATHER, "quantity_sold", test), test, "quantity_sold")


# ---------------------------------------------------------------- headers, roles and literal rows

HEADERS = {
    "quantity_sold": " Quantity--Sold ", "dt": "SALES Date", "expiry": "Expiry.Date", "product": "Product", "brand": "brand (name)", "holiday": "Holiday?", "disc": "% disc",
}


def odd_headers(v) -> DataFrame:
    """Sales with headers as people write them, in another order; the day column has a name of its own."""
    return v.sales.select(*[F.col(f"`{c}`").alias(to) for c, to in sorted(HEADERS.items())])


@query(
    "P2_detect_columns",
    """select dt date, expiry expiry_date, brand, count(*) n, cast(sum(cast(quantity_sold as decimal(18,2))) as double) quantity from sales where holiday = 1 group by all""",
    ("sales",),
)
def p2(v):
    """Day, expiry, event flag and brand found by their names in an unknown order of headers."""
    named = C.normalize_columns(odd_headers(v))
    day, expiry = C.find_date_column(named), C.detect(named.columns, C.EXPIRY_NAMES)
    flag, brand = C.detect(named.columns, C.EVENT_NAMES, substring=False), C.detect(named.columns, ("brand",))
    rows = C.require_columns(named, ["quantity_sold"]).where(F.col(flag) == 1)
    total = F.sum(F.col("quantity_sold").cast("decimal(18,2)")).cast("double")
    return rows.groupBy(F.col(day).alias("date"), F.col(expiry).alias("expiry_date"), F.col(brand).alias("brand")).agg(F.count(F.lit(1)).alias("n"), total.alias("quantity"))


@query(
    "P4_required_columns",
    """select brand, 'accepted' outcome, count(*) n from sales group by 1
union all select 'without quantity', 'sales lacks columns: quantity_sold', count(*) from sales
union all select 'without two', 'sales lacks columns: product, quantity_sold', count(*) from sales""",
    ("sales",),
)
def p4(v):
    """What the check says of the table, and of the table without some of its columns."""
    named = C.normalize_columns(odd_headers(v))
    need = ["product", "quantity_sold"]
    out = C.require_columns(named, need, "sales").groupBy(F.col("brand_name").alias("brand")).agg(F.lit("accepted").alias("outcome"), F.count(F.lit(1)).alias("n"))
    for label, gone in (("without quantity", ["quantity_sold"]), ("without two", need)):
        try:
            C.require_columns(named.drop(*gone), need, "sales")
        except ValueError as err:
            out = out.unionByName(named.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("brand"), F.lit(str(err)).alias("outcome"), "n"))
    return out


@query(
    "F5_role_split",
    """select 'quantity_sold' "column", 'numeric' role, cast(sum(cast(quantity_sold as decimal(18,2))) as double) value from sales
union all select 'shelf_life', 'numeric', sum(shelf_life)::double from sales union all select 'holiday', 'numeric', sum(holiday)::double from sales
union all select 'product', 'categorical', count(distinct product)::double from sales union all select 'brand', 'categorical', count(distinct brand)::double from sales
union all select 'discount', 'categorical', count(distinct discount)::double from sales""",
    ("sales",),
)
def f5(v):
    """Columns by role: the sum of each numeric one, the number of levels of each other, the target's day left out."""
    rows = v.sales.select("dt", "quantity_sold", "shelf_life", "holiday", "product", "brand", "discount")
    numeric, other = C.roles(rows, exclude=["dt"])
    sums = rows.agg(*[F.sum(F.col(c).cast("decimal(18,2)")).cast("double").alias(c) for c in numeric])
    # levels are counted as rows of distinct values, not in sets
    tall = rows.select(*other).unpivot([], other, "column", "level").where("level is not null").distinct()
    levels = tall.groupBy("column").agg(F.count(F.lit(1)).cast("double").alias("value")).withColumn("role", F.lit("categorical"))
    return sums.unpivot([], numeric, "column", "value").withColumn("role", F.lit("numeric")).unionByName(levels)


@query(
    "SRC4_literal_rows",
    DISCOUNT_SQL + f"""\nselect id, round({plane(DISCOUNT)}, 6) predicted_discount from
(values (1, 7, 0, 1, 0, 0), (2, 30, 6, 12, 1, 1), (3, null, 3, 6, 0, 1)) r(id, shelf_life, day_of_week, "month", holiday, event), es""",
    ("sales",),
)
def src4(v):
    """A few rows typed in by hand, scored by the model of all sales; what is not given is not known."""
    train, _ = discount_sides(v)
    like = train.select(F.lit(0).alias("id"), *DISCOUNT)
    given = [
        {"id": 1, "shelf_life": 7, "day_of_week": 0, "month": 1, "holiday": 0, "event": 0},
        {"id": 2, "shelf_life": 30, "day_of_week": 6, "month": 12, "holiday": 1, "event": 1},
        {"id": 3, "day_of_week": 3, "month": 6, "holiday": 0, "event": 1},
    ]
    rows = R.literal_rows(v.spark, given, like)
    model = kept_model(v, train, DISCOUNT, "discount_pct", rows)
    return rounded(L.score_linear(model, rows, "predicted_discount").select("id", "predicted_discount"), "predicted_discount")
