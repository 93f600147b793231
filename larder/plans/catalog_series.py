"""Queries for aggregations, windows, ranks, splits and feature encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import scalars as S
from larder.operators import calendar as C
from larder.operators import encode as E
from larder.operators import features as X
from larder.operators import metrics as M
from larder.operators import ordered as O
from larder.operators import splits as T
from larder.operators import waste as W
from larder.plans.registry import query
from larder.plans.views import SALE_KEY, TIE

KEY = "ok, ln, sk, xp, product_id"
ORDER = ["dt", *TIE]
ORDER_SQL = "dt, ok, ln, sk, xp, product_id"
# a limit this low makes most products hot, so that the chunked path is checked on small tables
LOW = 25


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in cols})


# ---------------------------------------------------------------- aggregations


@query(
    "A1_sum_by_keys",
    "select expiry expiry_date, category, product, cast(sum(cast(quantity_sold as decimal(18,2))) as double) total_quantity_sold from sales group by 1, 2, 3",
    ("sales",),
)
def a1(v):
    return W.sum_by_expiry(v.canonical)


@query("A2_distinct_ids", "select distinct p_brand brand from part order by 1")
def a2(v):
    return v.table("part").select(F.col("p_brand").alias("brand")).distinct().orderBy("brand")


@query(
    "A3_typical_duration",
    """select event_key, min(dur) duration_days from (select event_key, dur, n, max(n) over (partition by event_key) m
  from (select lower(event_name) event_key, dur, count(*) n from cal group by 1, 2)) where n = m group by 1""",
    ("cal",),
)
def a3(v):
    return C.typical_duration(v.cal)


@query("A4_date_quantile", "select round(quantile_cont(dt - date '1970-01-01', 0.8), 6) cutoff from moves", ("moves",))
def a4(v):
    return rounded(O.date_quantile(v.moves, "dt", 0.8), "cutoff")


@query(
    "A5_medians_and_modes",
    """select median(l_quantity) l_quantity, round(median(l_extendedprice), 6) l_extendedprice, median(l_discount) l_discount,
  (select p_brand from (select p_brand, count(*) n from part group by 1 order by n desc, p_brand limit 1)) p_brand,
  (select p_type from (select p_type, count(*) n from part group by 1 order by n desc, p_type limit 1)) p_type from lineitem""",
)
def a5(v):
    nums = E.medians(v.table("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    cats = E.modes(v.table("part"), ["p_brand", "p_type"])
    fitted = nums | cats
    row = v.spark.createDataFrame([tuple(fitted.values())], ", ".join(f"{c} {'double' if c in nums else 'string'}" for c in fitted))
    return rounded(row, "l_extendedprice")


@query(
    "A6_mean_and_spread",
    """select round(avg(x), 6) l_extendedprice_mean, round(stddev_pop(x), 6) l_extendedprice_std, median(q) l_quantity_median,
  round(avg(coalesce(q, (select median(nullif(l_quantity, 7)) from lineitem))), 6) l_quantity_mean
from (select l_extendedprice x, nullif(l_quantity, 7) q from lineitem)""",
)
def a6(v):
    items = v.table("lineitem").select("l_extendedprice", F.nullif("l_quantity", F.lit(7.0)).alias("l_quantity"))
    stats = E.numeric_stats(items, ["l_extendedprice", "l_quantity"])
    shown = {
        "l_extendedprice_mean": stats["l_extendedprice"]["mean"], "l_extendedprice_std": stats["l_extendedprice"]["std"],
        "l_quantity_median": stats["l_quantity"]["median"], "l_quantity_mean": stats["l_quantity"]["mean"],
    }
    row = v.spark.createDataFrame([tuple(shown.values())], ", ".join(f"{c} double" for c in shown))
    return rounded(row, "l_extendedprice_mean", "l_extendedprice_std", "l_quantity_mean")


METRICS_SQL = """round(avg(abs(y-p)), 9) "MAE", round(sqrt(avg((y-p)*(y-p))), 9) "RMSE",
  round(case when count(*) < 2 then null when var_pop(y) = 0 then case when avg((y-p)*(y-p)) = 0 then 1.0::double else 0 end
    else 1 - avg((y-p)*(y-p))/var_pop(y) end, 9) + 0.0 "R2",
  round(avg(case when y <> 0 then abs((y-p)/y) end)*100, 9) "MAPE\""""


@query("A7_regression_metrics", f"select product_id, count(*) n, {METRICS_SQL} from scored group by 1", ("scored",))
def a7(v):
    return rounded(M.regression_metrics(v.scored, "y", "p", ["product_id"]), *M.REGRESSION, digits=9)


@query(
    "A7b_event_metrics",
    f"""with r as (select s.*, event_name from scored s join cal on dt between a and b)
select k.brand product_id, 'HIGH Sale' event_name, coalesce(n, 0) n, "MAE", "RMSE", "R2", "MAPE"
from (select distinct p_partkey brand from part) k left join
  (select product_id, count(*) n, {METRICS_SQL} from r where event_name = 'HIGH Sale' group by 1) m on k.brand = m.product_id""",
    ("scored", "cal"),
)
def a7b(v):
    rows = C.join_calendar(v.scored, v.cal.drop("row_id", "duration_days"), "dt")
    asked = v.table("part").select(F.col("p_partkey").alias("product_id")).distinct().withColumn("event_name", F.lit("HIGH Sale"))
    return rounded(M.event_metrics(rows, asked, "y", "p", ["product_id"], "event_name"), *M.REGRESSION, digits=9)


@query(
    "A8_normalized_accuracy",
    "select model, round(least(greatest(1 - avg(abs(y-p))/(avg(abs(y)) + 1e-8), 0.0), 1.0), 6) accuracy from scored group by 1",
    ("scored",),
)
def a8(v):
    return rounded(M.normalized_accuracy(v.scored, "y", "p", ["model"]), "accuracy")


CLASSES_SQL = "classes as (select model, case when y >= 20 then 1 else 0 end t, case when p >= 15 then 1 else 0 end c from scored)"


def classes(v):
    return v.scored.select("model", S.at_least("y", 20).alias("t"), S.at_least("p", 15).alias("c"))


@query(
    "A9_confusion",
    f"""with {CLASSES_SQL} select m.model, a.x "true", b.x pred, count(c.model) n from (select distinct model from classes) m
cross join (values (0), (1), (2)) a(x) cross join (values (0), (1), (2)) b(x)
left join classes c on c.model = m.model and c.t = a.x and c.c = b.x group by 1, 2, 3""",
    ("scored",),
)
def a9(v):
    return M.confusion(classes(v), "t", "c", [0, 1, 2], ["model"])


REPORT_SQL = """labels as (select distinct model, t x from classes union select distinct model, c from classes),
counts as (select l.model, x, count(*) filter (where t = x) s, count(*) filter (where c = x) p, count(*) filter (where t = x and c = x) h
  from labels l join classes k on l.model = k.model group by 1, 2),
pr as (select *, case when p = 0 then 0.0::double else h/p end pre, case when s = 0 then 0.0::double else h/s end rec from counts),
report as (select model, x "label", s support, p predicted, h hits, pre "precision", rec recall,
  case when pre + rec = 0 then 0.0::double else 2*pre*rec/(pre+rec) end f1 from pr)"""
# the metrics of three quantile classes, cut separately for truth and prediction
QUANTILE_CLASSES_SQL = """e as (select list_distinct(list_transform(quantile_cont(y, [0.0, 1/3, 2/3, 1.0]), lambda x: round(x, 9))) ye,
  list_distinct(list_transform(quantile_cont(p, [0.0, 1/3, 2/3, 1.0]), lambda x: round(x, 9))) pe from scored),
classes as (select model, greatest(len(list_filter(ye, lambda x: x < y)) - 1, 0) t, greatest(len(list_filter(pe, lambda x: x < p)) - 1, 0) c
  from scored, e)"""


@query(
    "A10_class_report",
    f"""with {CLASSES_SQL}, {REPORT_SQL} select model, "label", support, predicted, hits, round("precision", 6) "precision",
  round(recall, 6) recall, round(f1, 6) f1 from report""",
    ("scored",),
)
def a10(v):
    return rounded(M.class_report(classes(v), "t", "c", ["model"]), "precision", "recall", "f1")


@query(
    "A10b_class_summary_quantile",
    f"""with {QUANTILE_CLASSES_SQL}, {REPORT_SQL} select model,
  round(sum(hits) filter (where support > 0) / sum(predicted) filter (where support > 0), 6) accuracy,
  round(avg("precision"), 6) macro_precision, round(avg(recall), 6) macro_recall, round(avg(f1), 6) macro_f1 from report group by 1""",
    ("scored",),
)
def a10b(v):
    cut = X.quantile_classes(X.quantile_classes(v.scored, "y", 3, "t"), "p", 3, "c")
    summary = M.class_summary(M.class_report(cut, "t", "c", ["model"]), ["model"])
    return rounded(summary, "accuracy", "macro_precision", "macro_recall", "macro_f1")


@query(
    "A11_residual_histogram",
    """with r as (select y - p r from scored), s as (select min(r) lo, max(r) hi from r)
select cast(least(30, floor((r - lo)/(hi - lo)*30) + 1) as int) bin, count(*) n from r, s group by 1""",
    ("scored",),
)
def a11(v):
    return M.histogram(M.residuals(v.scored, "y", "p"), "residual", 30)


FOLDS_SQL = f"""folds as (select model, year(dt) fold, case when year(dt) = 1999 then 'failed' end error, {METRICS_SQL} from scored group by 1, 2)"""


@query(
    "A12_fold_means",
    f"""with {FOLDS_SQL} select model, round(avg("MAE") filter (where error is null), 6) "MAE", round(avg("RMSE") filter (where error is null), 6) "RMSE",
  round(avg("R2") filter (where error is null), 6) + 0.0 "R2", count(*) filter (where error is null) folds from folds group by 1""",
    ("scored",),
)
def a12(v):
    folds = M.regression_metrics(v.scored.withColumn("fold", F.year("dt")), "y", "p", ["model", "fold"])
    folds = rounded(folds, *M.REGRESSION, digits=9).withColumn("error", F.when(F.col("fold") == 1999, "failed"))
    return rounded(M.fold_means(folds), "MAE", "RMSE", "R2")


@query(
    "A13_window_span",
    "select event_name, min(a) window_start, max(b) window_end from cal group by 1",
    ("cal",),
)
def a13(v):
    spans = v.cal.withColumnsRenamed({"start_date": "window_start", "end_date": "window_end"})
    return M.window_span(spans, ["event_name"])


@query("A14_model_comparison", f"select model, count(*) n, {METRICS_SQL} from scored group by 1", ("scored",))
def a14(v):
    return rounded(M.regression_metrics(v.scored, "y", "p", ["model"]), *M.REGRESSION, digits=9)


@query(
    "A15_window_sums",
    "select product_id, event_name, row_id, sum(quantity_sold) total from moves join cal on dt between a and b group by 1, 2, 3",
    ("moves", "cal"),
)
def a15(v):
    rows = C.join_calendar(v.moves.select("dt", "product_id", "quantity_sold"), v.cal.withColumn("event_name", F.struct("row_id", "event_name")), "dt")
    return rows.groupBy("product_id", "event_name.row_id", "event_name.event_name").agg(F.sum("quantity_sold").alias("total"))


# ---------------------------------------------------------------- windows

SERIES_SQL = f"""select {KEY}, dt, quantity_sold, lag(quantity_sold, 1) over w lag_quantity_sold_1,
  lag(quantity_sold, 7) over w lag_quantity_sold_7, lag(quantity_sold, 28) over w lag_quantity_sold_28 from moves
window w as (partition by product_id order by {ORDER_SQL})"""
MEAN_SQL = """case when count(quantity_sold) over {f} >= {m} then round(avg(quantity_sold) over {f}, 6) end rmean_quantity_sold_{n}"""


def rolling_sql(first: str, last: str, source: str = "moves") -> str:
    cols = []
    for n in (7, 28):
        frame = f"(partition by product_id order by {ORDER_SQL} rows between {first.format(n=n, p=n - 1)} and {last})"
        cols.append(MEAN_SQL.format(f=frame, m=n // 2, n=n))
    return f"select {KEY}, dt, {', '.join(cols)} from {source}"


ROLLING_SQL = rolling_sql("{p} preceding", "current row")


def series(v):
    return v.moves.select(*SALE_KEY, "dt", "quantity_sold")


@query("W1_lags", SERIES_SQL, ("moves",))
def w1(v):
    return X.add_lag_rolling(series(v), ["product_id"], ORDER, "quantity_sold", rolls=())


@query("W1b_lags_hot_products", SERIES_SQL, ("moves",))
def w1b(v):
    return X.add_lag_rolling(series(v), ["product_id"], ORDER, "quantity_sold", rolls=(), hot_rows=LOW)


def means(df: DataFrame) -> DataFrame:
    return rounded(df.drop("quantity_sold"), "rmean_quantity_sold_7", "rmean_quantity_sold_28")


@query("W2_rolling_means", ROLLING_SQL, ("moves",))
def w2(v):
    return means(X.add_lag_rolling(series(v), ["product_id"], ORDER, "quantity_sold", lags=()))


@query("W2b_rolling_means_hot_products", ROLLING_SQL, ("moves",))
def w2b(v):
    return means(X.add_lag_rolling(series(v), ["product_id"], ORDER, "quantity_sold", lags=(), hot_rows=LOW))


@query("W2c_rolling_means_past_only", rolling_sql("{n} preceding", "1 preceding"), ("moves",))
def w2c(v):
    return means(X.add_lag_rolling(series(v), ["product_id"], ORDER, "quantity_sold", lags=(), exclude_current=True))


@query(
    "W3_future_features",
    f"""with u as (select {KEY}, dt, case when dt < date '2001-01-01' then quantity_sold end quantity_sold from moves),
w as (select {KEY}, dt, lag(quantity_sold, 1) over w lag_quantity_sold_1, lag(quantity_sold, 7) over w lag_quantity_sold_7,
  case when count(quantity_sold) over (w rows between 6 preceding and current row) >= 3
    then round(avg(quantity_sold) over (w rows between 6 preceding and current row), 6) end rmean_quantity_sold_7
  from u window w as (partition by product_id order by {ORDER_SQL}))
select * from w where dt >= date '2001-01-01'""",
    ("moves",),
)
def w3(v):
    start = F.lit("2001-01-01").cast("date")
    history = series(v).filter(F.col("dt") < start)
    future = series(v).filter(F.col("dt") >= start).drop("quantity_sold")
    out = X.add_lag_rolling_future(future, history, ["product_id"], ORDER, "quantity_sold", lags=(1, 7), rolls=(7,))
    return rounded(out.drop("quantity_sold"), "rmean_quantity_sold_7")


@query(
    "W4_last_known",
    "select product_id, arg_max(shelf_life, (dt, ok, ln, sk, xp)) shelf_life, arg_max(discount, (dt, ok, ln, sk, xp)) discount, arg_max(unit_price, (dt, ok, ln, sk, xp)) unit_price from sales group by 1",
    ("sales",),
)
def w4(v):
    return X.last_known(v.sales, ["product_id"], ORDER, ["shelf_life", "discount", "unit_price"])


TAIL_SQL = f"""select {KEY}, case when row_number() over (partition by product_id order by {ORDER_SQL})
  > count(*) over (partition by product_id) - ceil(count(*) over (partition by product_id) * 0.1::double - 1e-9) then 'test' else 'train' end split from moves"""


@query("W5_tail_split", TAIL_SQL, ("moves",))
def w5(v):
    return T.tail_split(v.moves.select(*SALE_KEY, "dt"), ["product_id"], ORDER, 0.1).drop("dt")


@query("W5b_tail_split_hot_products", TAIL_SQL, ("moves",))
def w5b(v):
    return T.tail_split(v.moves.select(*SALE_KEY, "dt"), ["product_id"], ORDER, 0.1, hot_rows=LOW).drop("dt")


@query(
    "W5c_tail_split_floor_train",
    f"""select {KEY}, case when row_number() over (partition by product_id order by {ORDER_SQL})
  > floor(count(*) over (partition by product_id) * (1 - 0.1::double) + 1e-9) then 'test' else 'train' end split from moves""",
    ("moves",),
)
def w5c(v):
    return T.tail_split(v.moves.select(*SALE_KEY, "dt"), ["product_id"], ORDER, 0.1, floor_train=True).drop("dt")


@query(
    "W6_label_codes",
    f"""with k as (select product, row_number() over (order by product) - 1 product_enc from (select distinct product from sales))
select {KEY}, product, product_enc from sales join k using (product)""",
    ("sales",),
)
def w6(v):
    return X.label_codes(v.sales.select(*SALE_KEY, "product"), "product")


RANK_SQL = f"""r as (select {KEY}, xp2, (rank() over (order by xp2) + (count(*) over (partition by xp2) - 1)/2)::double / count(*) over () pct
  from (select {KEY}, floor(xp/10) xp2 from moves))"""


@query("W7_percent_rank", f"with {RANK_SQL} select {KEY}, round(pct, 9) pct from r", ("moves",))
def w7(v):
    rows = v.moves.select(*SALE_KEY, F.floor(F.col("xp") / 10).alias("xp2"))
    return rounded(X.percent_rank_average(rows, "xp2"), "pct", digits=9).drop("xp2")


def edges_sql(q: int, expr: str) -> str:
    probs = ", ".join(f"{i}/{q}::double" for i in range(q + 1))
    return f"list_sort(list_distinct(list_transform(quantile_cont({expr}, [{probs}]), lambda x: round(x, 9))))"


def bins_sql(q: int, expr: str, source: str) -> str:
    return f"""e as (select {edges_sql(q, expr)} wide, {edges_sql(max(2, q // 2), expr)} narrow from {source}),
b as (select *, case when len(wide) > 2 then greatest(len(list_filter(wide, lambda x: x < round({expr}, 9))) - 1, 0)
  when len(narrow) > 1 then greatest(len(list_filter(narrow, lambda x: x < round({expr}, 9))) - 1, 0) else 0 end bin from {source}, e)"""


@query("W8_quantile_bins", f"with {bins_sql(5, 'xp', 'moves')} select {KEY}, bin from b", ("moves",))
def w8(v):
    return X.qcut(v.moves.select(*SALE_KEY), "xp", 5)


@query(
    "W8b_quantile_bins_ties",
    f"with t as (select *, least(greatest(quantity_sold, 30), 31) capped from moves), {bins_sql(5, 'capped', 't')} select {KEY}, capped, bin from b",
    ("moves",),
)
def w8b(v):
    capped = F.least(F.greatest("quantity_sold", F.lit(30.0)), F.lit(31.0))
    return X.qcut(v.moves.select(*SALE_KEY, capped.alias("capped")), "capped", 5)


@query(
    "W9_equal_width_bins",
    f"""with {RANK_SQL}, s as (select min(pct) lo, max(pct) hi from r),
e as (select list_transform(range(0, 5), lambda i: lo + i*((hi-lo)/5)) edges from s)
select {KEY}, greatest(len(list_filter(edges, lambda x: x < pct)) - 1, 0) bin from r, e""",
    ("moves",),
)
def w9(v):
    rows = v.moves.select(*SALE_KEY, F.floor(F.col("xp") / 10).alias("xp2"))
    return X.equal_width_bins(X.percent_rank_average(rows, "xp2"), "pct", 5).drop("xp2", "pct")


@query(
    "W10_window_index",
    "select row_id, event_name, a start_date, row_number() over (partition by lower(event_name) order by a, row_id) window_index from cal",
    ("cal",),
)
def w10(v):
    return C.event_windows(v.cal).select("row_id", "event_name", "start_date", "window_index")


# ---------------------------------------------------------------- sorts and unions


@query("S1_series_order", f"select {KEY}, dt from moves order by product_id, {ORDER_SQL}", ("moves",))
def s1(v):
    return v.moves.select(*SALE_KEY, "dt").orderBy("product_id", *ORDER)


@query(
    "S2_top_products",
    "select product_id, sum(cast(quantity_sold as bigint)) sold from moves group by 1 order by sold desc, product_id limit 20",
    ("moves",),
)
def s2(v):
    totals = v.moves.groupBy("product_id").agg(F.sum(F.col("quantity_sold").cast("bigint")).alias("sold"))
    return totals.orderBy(F.desc("sold"), "product_id").limit(20)


@query(
    "U1_union_same",
    f"select {KEY}, 'history' part from moves where dt < date '2001-01-01' union all select {KEY}, 'recent' from moves where dt >= date '2001-01-01'",
    ("moves",),
)
def u1(v):
    start = F.lit("2001-01-01").cast("date")
    old = v.moves.filter(F.col("dt") < start).select(*SALE_KEY, F.lit("history").alias("part"))
    new = v.moves.filter(F.col("dt") >= start).select(*SALE_KEY, F.lit("recent").alias("part"))
    return old.unionByName(new)


@query(
    "U2_union_differing",
    f"select {KEY}, case when dt < date '2001-01-01' then quantity_sold end quantity_sold, case when dt >= date '2001-01-01' then 1 else 0 end is_future from moves",
    ("moves",),
)
def u2(v):
    start = F.lit("2001-01-01").cast("date")
    old = v.moves.filter(F.col("dt") < start).select(*SALE_KEY, "quantity_sold", F.lit(0).alias("is_future"))
    new = v.moves.filter(F.col("dt") >= start).select(*SALE_KEY, F.lit(1).alias("is_future"))
    return old.unionByName(new, allowMissingColumns=True)


# ---------------------------------------------------------------- splits and folds

HASH = "md5(concat_ws('|', '42', {k}))"
ROW_HASH = HASH.format(k="ok::varchar, ln::varchar, sk::varchar, product_id::varchar, cast(xp*100 as bigint)::varchar")
WORD = "('0x'||substr({h},1,8))::bigint"


def keyed(v) -> DataFrame:
    """Rows with a whole-number price for the hash, so that both engines hash the same text."""
    return v.moves.select(*SALE_KEY, "dt", "quantity_sold", F.round(F.col("xp") * 100).cast("bigint").alias("cents"))


HASHED = ["ok", "ln", "sk", "product_id", "cents"]


@query("C1_hash_split", f"select {KEY}, case when {WORD.format(h=ROW_HASH)}/4294967296.0::double < 0.2 then 'test' else 'train' end split from moves", ("moves",))
def c1(v):
    return T.hash_split(keyed(v), HASHED, 0.2).select(*SALE_KEY, "split")


@query(
    "C2_time_split",
    f"select {KEY}, case when dt - date '1970-01-01' > (select quantile_cont(dt - date '1970-01-01', 0.8) from moves) then 'test' else 'train' end split from moves",
    ("moves",),
)
def c2(v):
    return T.time_split(v.moves.select(*SALE_KEY, "dt"), "dt", 0.2).drop("dt")


@query(
    "C3_group_split",
    f"""with g as (select product_id, row_number() over (order by {HASH.format(k='product_id::varchar')}) r, count(*) over () g from (select distinct product_id from moves))
select {KEY}, case when r > g - ceil(g*0.2::double - 1e-9) then 'test' else 'train' end split from moves join g using (product_id)""",
    ("moves",),
)
def c3(v):
    return T.group_split(v.moves.select(*SALE_KEY), "product_id", 0.2)


@query("C4_kfold", f"select {KEY}, cast({WORD.format(h=ROW_HASH)} % 5 as int) fold from moves", ("moves",))
def c4(v):
    return T.kfold(keyed(v), HASHED, 5).select(*SALE_KEY, "fold")


@query("C5_group_kfold", f"select {KEY}, cast({WORD.format(h=HASH.format(k='product_id::varchar'))} % 5 as int) fold from moves", ("moves",))
def c5(v):
    return T.group_kfold(v.moves.select(*SALE_KEY), "product_id", 5)


@query(
    "C6_stratified_kfold",
    f"""with {bins_sql(5, 'quantity_sold', 'moves')} select {KEY},
  cast((row_number() over (partition by bin order by {ROW_HASH}, ok, ln, sk, product_id, xp) - 1) % 5 as int) fold from b""",
    ("moves",),
)
def c6(v):
    return T.stratified_kfold(keyed(v), "quantity_sold", HASHED, 5).select(*SALE_KEY, "fold")


BLOCKS_SQL = f"""with r as (select {KEY}, row_number() over (order by {ORDER_SQL}) r, count(*) over () n from moves), z as (select *, n // 4 z from r)
select {KEY}, cast(greatest(0, ceil((r - (n - 3*z))/z)) as int) block from z"""


@query("C7_time_series_blocks", BLOCKS_SQL, ("moves",))
def c7(v):
    return T.time_series_blocks(v.moves.select(*SALE_KEY, "dt"), [*ORDER, "product_id"], 3).drop("dt")


@query("C7b_time_series_blocks_hot_days", BLOCKS_SQL, ("moves",))
def c7b(v):
    return T.time_series_blocks(v.moves.select(*SALE_KEY, "dt"), [*ORDER, "product_id"], 3, hot_rows=10).drop("dt")


# ---------------------------------------------------------------- feature encoding


@query(
    "F1_numeric_features",
    f"""with x as (select {KEY}, quantity_sold q, nullif(quantity_sold, 7) gap, 5.0::double flat from moves),
i as (select *, coalesce(gap, (select median(gap) from x)) g from x),
s as (select avg(q) mq, stddev_pop(q) sq, avg(g) mg, stddev_pop(g) sg from i)
select {KEY}, round((q - mq)/sq, 6) + 0.0 q, round((g - mg)/sg, 6) + 0.0 gap, 0.0::double flat from i, s""",
    ("moves",),
)
def f1(v):
    q = F.col("quantity_sold")
    rows = v.moves.select(*SALE_KEY, q.alias("q"), F.nullif(q, F.lit(7.0)).alias("gap"), F.lit(5.0).alias("flat"))
    return rounded(E.numeric_features(rows, ["q", "gap", "flat"]), "q", "gap", "flat")


@query(
    "F2_impute_categories",
    """select event_id, coalesce(nullif(event_type, 'error'), 'missing') constant, coalesce(nullif(event_type, 'error'),
  (select event_type from (select event_type, count(*) n from events where event_type <> 'error' group by 1 order by n desc, event_type limit 1))) frequent
from events""",
)
def f2(v):
    gap = F.nullif("event_type", F.lit("error"))
    rows = v.table("events").select("event_id", gap.alias("constant"), gap.alias("frequent"))
    rows = E.impute_categories(rows, ["frequent"], "most_frequent")
    return E.impute_categories(rows, ["constant"])


@query(
    "F3_one_hot",
    """select event_id, case when event_type = 'click' then 1 else 0 end kind_click, case when event_type = 'purchase' then 1 else 0 end kind_purchase,
  case when event_type = 'view' then 1 else 0 end kind_view from events""",
)
def f3(v):
    # error and signup stand for levels that were not there when the encoder was fitted
    rows = v.table("events").select("event_id", F.col("event_type").alias("kind"))
    return E.one_hot(rows, "kind", ["click", "purchase", "view"]).drop("kind")


@query(
    "F3b_one_hot_pipeline",
    """select event_id, case when event_type = 'click' then 1.0::double else 0 end click, case when event_type = 'error' then 1.0::double else 0 end error,
  case when event_type = 'purchase' then 1.0::double else 0 end purchase from events""",
)
def f3b(v):
    from pyspark.ml.functions import vector_to_array

    rows = v.table("events").select("event_id", F.col("event_type").alias("kind"))
    known = rows.filter(F.col("kind").isin("click", "error", "purchase"))
    fitted = E.feature_pipeline(known, [], ["kind"]).fit(known)
    hot = fitted.transform(rows).select("event_id", vector_to_array("features").alias("x"))
    return hot.select("event_id", *[F.col("x")[i].alias(n) for i, n in enumerate(("click", "error", "purchase"))])


@query(
    "F4_dummies_drop_first",
    "select o_orderkey ok, case when o_orderstatus = 'O' then 1 else 0 end status_O, case when o_orderstatus = 'P' then 1 else 0 end status_P from orders",
)
def f4(v):
    rows = v.orders.select(F.col("o_orderkey").alias("ok"), F.col("o_orderstatus").alias("status"))
    return E.one_hot(rows, "status", E.fitted_levels(rows, "status"), drop_first=True).drop("status")
