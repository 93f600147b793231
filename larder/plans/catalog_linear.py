"""Queries of the moment-based linear models, with the same algebra written out in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import scalars as S
from larder.operators import boosting as B
from larder.operators import encode as E
from larder.operators import importance as P
from larder.operators import linear as L
from larder.operators import splits as T
from larder.operators.metrics import residuals
from larder.plans.catalog_series import HASH, ORDER, ORDER_SQL, WORD, rounded
from larder.plans.registry import query
from larder.plans.views import SALE_KEY
from larder.session import materialize

FEATURES = ("shelf_life", "unit_price", "disc", "dow", "month", "holiday", "event")
CV_MODELS = {"price": ("unit_price", "disc"), "calendar": ("dow", "month", "holiday"), "all": FEATURES}
TARGET = "quantity_sold"
TEST_SHARE = 0.2

ROW_WORD = WORD.format(h=HASH.format(k="concat_ws('|', ok, ln, sk, product_id)"))
ROWS_SQL = f"""rows_ as (select *, isodow(dt) - 1 dow, month(dt) "month", {ROW_WORD} / 4294967296.0::double u from sales)"""


def _name(i: int, j: int) -> str:
    return f"g{min(i, j)}_{max(i, j)}"


def moments_sql(source: str, columns: Sequence[str], by: str) -> str:
    """n, s<i> and p<i>_<j> per group."""
    x = [f'cast("{c}" as decimal(18,6))' for c in columns]
    sums = [f"sum({c}) s{i}" for i, c in enumerate(x)]
    products = [f"sum({x[i]} * {x[j]}) p{i}_{j}" for i in range(len(x)) for j in range(i, len(x))]
    return f"select {by}, count(*) n, {', '.join(sums + products)} from {source} group by all"


def solve_sql(source: str, columns: Sequence[str], features: Sequence[str], prefix: str, key: str) -> tuple[str, str]:
    """Common table expressions that eliminate feature by feature, and the name of the one with b0 .. bk and a."""
    at = [columns.index(c) for c in features]
    y, k = len(columns) - 1, len(features)
    every = [*at, y]
    spread = lambda i, j: f"(p{min(i, j)}_{max(i, j)} - s{i}::double * s{j}::double / n)::double"
    means = ", ".join(f"s{i}::double / n m{q}" for q, i in enumerate(every))
    cells = ", ".join(f"{spread(i, j)} g{r}_{c}" for r, i in enumerate(at) for c, j in enumerate(every))
    steps = [f"{prefix}0 as (select {key}, {means}, {cells} from {source})"]
    for p in range(k):
        cells = ", ".join(
            f"g{r}_{c}" if r == p else f"g{r}_{c} - g{r}_{p} / g{p}_{p} * g{p}_{c} g{r}_{c}" for r in range(k) for c in range(k + 1)
        )
        steps.append(f"{prefix}{p + 1} as (select {key}, {', '.join(f'm{q}' for q in range(k + 1))}, {cells} from {prefix}{p})")
    slopes = ", ".join(f"g{p}_{k} / g{p}_{p} b{p}" for p in range(k))
    steps.append(f"{prefix}s as (select *, m{k} - {' - '.join(f'b{p} * m{p}' for p in range(k))} a from (select *, {slopes} from {prefix}{k}))")
    return ",\n".join(steps), f"{prefix}s"


def _plane(features: Sequence[str]) -> str:
    return "a + " + " + ".join(f'b{p} * "{c}"' for p, c in enumerate(features))


_COLUMNS = [*FEATURES, TARGET]
_SOLVE, _SOLVED = solve_sql("mom", _COLUMNS, FEATURES, "e", "one")
FIT_SQL = f"""with {ROWS_SQL},
mom as ({moments_sql(f'(select * from rows_ where u >= {TEST_SHARE})', _COLUMNS, '1 one')}),
{_SOLVE}"""


def split_rows(v) -> DataFrame:
    return T.hash_split(v.sales.withColumns(S.time_parts("dt")), ["ok", "ln", "sk", "product_id"], TEST_SHARE)


def scored_rows(v) -> DataFrame:
    rows = split_rows(v)
    model = L.fit_linear(rows.where("split = 'train'"), FEATURES, TARGET)
    return L.score_linear(model, rows.where("split = 'test'")).select(*SALE_KEY, TARGET, "prediction")


@query(
    "M3c_linear_from_moments",
    FIT_SQL + f"""
select ok, ln, sk, xp, product_id, quantity_sold, round({_plane(FEATURES)}, 6) prediction from rows_, {_SOLVED} where u < {TEST_SHARE}""",
    ("sales",),
)
def m3c(v):
    return rounded(scored_rows(v), "prediction", digits=6)


@query(
    "M3d_linear_coefficients",
    FIT_SQL + "\n" + " union all ".join(f"select '{c}' feature, round(b{p}, 6) coefficient from {_SOLVED}" for p, c in enumerate(FEATURES)) + f" union all select 'intercept', round(a, 6) from {_SOLVED}",
    ("sales",),
)
def m3d(v):
    model = L.fit_linear(split_rows(v).where("split = 'train'"), FEATURES, TARGET)
    rows = [*zip(model.features, model.coefficients, strict=True), ("intercept", model.intercept)]
    return rounded(v.spark.createDataFrame(rows, "feature string, coefficient double"), "coefficient", digits=6)


@query(
    "M8b_linear_residuals",
    FIT_SQL + f"""
select ok, ln, sk, xp, product_id, quantity_sold, round(p, 6) prediction, round(quantity_sold - p, 6) + 0.0 residual
from (select *, {_plane(FEATURES)} p from rows_, {_SOLVED} where u < {TEST_SHARE})""",
    ("sales",),
)
def m8b(v):
    return rounded(residuals(scored_rows(v), TARGET, "prediction"), "prediction", "residual", digits=6)


SHUFFLE_BUCKETS = 16


def _importance_sql() -> str:
    key = "concat_ws('|', ok, ln, sk, product_id, cents)"
    every = ", ".join(f'"{c}"' for c in FEATURES)
    moved = []
    for i, c in enumerate(FEATURES):
        over = f"(partition by bucket order by md5(concat_ws('|', '{43 + i}', {key})), {every}"
        moved.append(f'coalesce(lead("{c}") over {over}), first_value("{c}") over {over} rows unbounded preceding)) z{i}')
    rmse = "sqrt(avg((quantity_sold - ({p})) * (quantity_sold - ({p}))))"
    errors = [rmse.format(p=_plane(FEATURES)) + " rmse"]
    for i, c in enumerate(FEATURES):
        errors.append(rmse.format(p=_plane(FEATURES).replace(f'b{i} * "{c}"', f"b{i} * z{i}")) + f" e{i}")
    rows = " union all ".join(f"select '{c}' feature, rmse, e{i} e from errors" for i, c in enumerate(FEATURES))
    return FIT_SQL + f""",
bucketed as (select *, {WORD.format(h=HASH.format(k=key))} % {SHUFFLE_BUCKETS} bucket from (select *, cast(round(xp * 100) as bigint) cents from rows_ where u < {TEST_SHARE})),
moved as (select *, {', '.join(moved)} from bucketed),
errors as (select {', '.join(errors)} from moved, {_SOLVED})
select feature, round(rmse, 6) rmse, round(e, 6) shuffled_rmse, round(e - rmse, 6) + 0.0 importance from ({rows})"""


@query("M7b_permutation_importance", _importance_sql(), ("sales",))
def m7b(v):
    rows = split_rows(v)
    model = L.fit_linear(rows.where("split = 'train'"), FEATURES, TARGET)
    test = rows.where("split = 'test'").withColumn("cents", F.round(F.col("xp") * 100).cast("bigint"))
    out = P.permutation_importance(test, model.predict, FEATURES, TARGET, ["ok", "ln", "sk", "product_id", "cents"], buckets=SHUFFLE_BUCKETS)
    return rounded(out, "rmse", "shuffled_rmse", "importance", digits=6)


def _cv_sql(expanding: bool, folds: Sequence[int], rows: str) -> str:
    every = list(dict.fromkeys(c for f in CV_MODELS.values() for c in f))
    columns = [*every, TARGET]
    names = [f"s{i}" for i in range(len(columns))] + [f"p{i}_{j}" for i in range(len(columns)) for j in range(i, len(columns))]
    side = "t.fold < f.fold" if expanding else "t.fold <> f.fold"
    parts = [
        rows,
        f"folds as (select unnest([{', '.join(map(str, folds))}]) fold)",
        f"mom as materialized ({moments_sql('folded', columns, 'fold')})",
        f"train as materialized (select f.fold, sum(t.n) n, {', '.join(f'sum(t.{c}) {c}' for c in names)} from folds f join mom t on {side} group by all)",
    ]
    out = []
    for q, (name, features) in enumerate(CV_MODELS.items()):
        steps, solved = solve_sql("train", columns, features, f"m{q}_", "fold")
        parts.append(steps)
        metrics = f"""count(*) n, avg(abs(y - p)) mae, sqrt(avg((y - p) * (y - p))) rmse,
    case when count(*) < 2 then null else 1 - avg((y - p) * (y - p)) / var_pop(y) end r2"""
        parts.append(f"r{q} as (select fold, {metrics} from (select fold, quantity_sold y, {_plane(features)} p from folded join {solved} using (fold)) group by fold)")
        out.append(
            f"""select '{name}' model, f.fold::int fold, coalesce(r.n, c.n, 0) n, round(mae, 6) "MAE", round(rmse, 6) "RMSE", round(r2, 6) "R2",
  case when t.fold is null then 'no rows to train on' when c.fold is null then 'no rows to test' end error
from folds f left join train t using (fold) left join (select fold, n from mom) c using (fold) left join r{q} r on r.fold = f.fold and t.fold is not null"""
        )
    return "with " + ",\n".join(parts) + "\n" + " union all\n".join(out)


@query(
    "C8b_cross_validate_moments",
    _cv_sql(
        True, (0, 1, 2, 3),
        f"""ordered as (select *, isodow(dt) - 1 dow, month(dt) "month", row_number() over (order by {ORDER_SQL}) pos, count(*) over () n_all from sales),
folded as (select *, greatest(0, ceil((pos - (n_all - 2 * (n_all // 3))) / (n_all // 3)::double))::int fold from ordered)""",
    ),
    ("sales",),
)
def c8b(v):
    """Expanding blocks; block 0 has nothing before it and there is no block 3, so both are rows with an error."""
    # blocks are found in three scans
    rows = materialize(v.sales.withColumns(S.time_parts("dt")).select(*dict.fromkeys([*ORDER, *FEATURES, TARGET])))
    rows = T.time_series_blocks(rows, [*ORDER], 2)
    out = L.cross_validate_linear(rows, CV_MODELS, TARGET, "block", (0, 1, 2, 3), expanding=True)
    return rounded(out, "MAE", "RMSE", "R2", digits=6)


@query(
    "C8c_kfold_moments",
    _cv_sql(False, (0, 1, 2, 3, 4), f"""folded as (select *, isodow(dt) - 1 dow, month(dt) "month", cast({ROW_WORD} % 5 as int) fold from sales)"""),
    ("sales",),
)
def c8c(v):
    rows = T.kfold(v.sales.withColumns(S.time_parts("dt")), ["ok", "ln", "sk", "product_id"], 5)
    out = L.cross_validate_linear(rows, CV_MODELS, TARGET, "fold", range(5), expanding=False)
    return rounded(out, "MAE", "RMSE", "R2", digits=6)


# ---------------------------------------------------------------- boosted trees, one cut deep

# shelf life is missing for sales on credit terms, so that trees meet missing values
STUMP_EDGES = ((10.0, 20.0, 30.0, 40.0), (0.025, 0.045, 0.075))
STUMP_FEATURES = ("shelf", "disc")
STUMP_RATE, STUMPS = 0.5, 2
RESIDUAL_SQL = "cast({x} as decimal(18,6))"


def stump_rows(v) -> DataFrame:
    shelf = F.when(F.col("priority") != "5-LOW", F.col("shelf_life").cast("double"))
    return v.sales.select(*SALE_KEY, shelf.alias("shelf"), "disc", "quantity_sold")


def stumps(v, keys: Sequence[str]) -> DataFrame:
    params = {**B.DEFAULTS, "n_estimators": STUMPS, "max_depth": 1, "learning_rate": STUMP_RATE}
    rows = stump_rows(v)
    model = B.fit_boosted(rows, STUMP_FEATURES, "quantity_sold", keys, SALE_KEY, params, STUMP_EDGES)
    return rounded(B.score_boosted(model, rows).select(*SALE_KEY, "prediction"), "prediction", digits=4)


def _stump_sql(key: str) -> str:
    """Two rounds of trees with one cut each, for every group."""
    def bins(column: str, edges: Sequence[float]) -> str:
        return f"case when {column} is not null then " + " + ".join(f"({column} > {e})::int" for e in edges) + " end"

    parts = [
        f"""base as materialized (select *, row_number() over () rid, {key} k, quantity_sold::double y, {bins('shelf', STUMP_EDGES[0])} b0, {bins('disc', STUMP_EDGES[1])} b1
  from (select ok, ln, sk, xp, product_id, case when priority <> '5-LOW' then shelf_life::double end shelf, disc, quantity_sold from sales))""",
        "p0 as materialized (select k, rid, b0, b1, y, round(sum(cast(y as decimal(18,6))) over (partition by k)::double / count(*) over (partition by k), 6) p from base)",
    ]
    for t in range(STUMPS):
        half = "{g} * {g} / ({n} + 1.0::double)"
        gain = f"{half.format(g='gl', n='nl')} + {half.format(g='gr', n='nr')} - {half.format(g='gt', n='nt')}"
        parts += [
            f"""h{t} as (select k, f, b, sum(r) g, count(*) n from (
  select k, cast(y - p as decimal(18,6)) r, unnest([0, 1]) f, unnest([b0, b1]) b from p{t}) group by all)""",
            f"""c{t} as (select k, f, b, sum(g) over w gt, sum(n) over w nt, coalesce(sum(g) filter (b is not null) over u, 0) gl, coalesce(sum(n) filter (b is not null) over u, 0) nl,
  coalesce(sum(g) filter (b is null) over w, 0) gm, coalesce(sum(n) filter (b is null) over w, 0) nm from h{t}
  window w as (partition by k, f), u as (partition by k, f order by b nulls first rows unbounded preceding))""",
            f"""d{t} as (select k, f, b, true m, gt::double gt, nt::double nt, (gl + gm)::double gl, (nl + nm)::double nl, (gt - gl - gm)::double gr, (nt - nl - nm)::double nr from c{t} where b is not null
  union all select k, f, b, false, gt::double, nt::double, gl::double, nl::double, (gt - gl)::double, (nt - nl)::double from c{t} where b is not null)""",
            f"""s{t} as materialized (select * from (select *, round({gain}, 6) gain, row_number() over (partition by k order by round({gain}, 6) desc, f, b, m desc) nth from d{t} where nl >= 1 and nr >= 1) where nth = 1 and gain > 1e-6)""",
            f"""t{t} as (select k, sum(g)::double / (sum(n) + 1.0::double) root from h{t} where f = 0 group by k)""",
            f"""p{t + 1} as materialized (select a.k, rid, b0, b1, y, p + {STUMP_RATE}::double * case when s.k is null then root
    when coalesce(case f when 0 then b0 else b1 end <= s.b, s.m) then gl / (nl + 1.0::double) else gr / (nr + 1.0::double) end p
  from p{t} a left join s{t} s on s.k = a.k left join t{t} r on r.k = a.k)""",
        ]
    return "with " + ",\n".join(parts) + f"\nselect ok, ln, sk, xp, product_id, round(p, 4) + 0.0 prediction from base join p{STUMPS} using (rid)"


@query("M4b_boosted_stumps_per_product", _stump_sql("product_id"), ("sales",))
def m4b(v):
    """A model per product, all products in the same jobs."""
    return stumps(v, ["product_id"])


@query("M1b_boosted_stumps_missing", _stump_sql("1"), ("sales",))
def m1b(v):
    """One model over the whole table, with missing feature values."""
    return stumps(v, [])


# ---------------------------------------------------------------- many levels, crowded tie-breaks


@query(
    "F3b_many_levels",
    """with r as (select ok, ln, sk, xp, product_id, concat(product, ' / ', ok % 40) lvl from sales), d as (select lvl, row_number() over (order by lvl) - 1 i from (select distinct lvl from r))
select ok, ln, sk, xp, product_id, i place, (select count(*) from d) size from r join d using (lvl)""",
    ("sales",),
)
def f3b(v):
    """A level for nearly every row: a sparse vector each, made by joins with the dictionary."""
    rows = v.sales.select(*SALE_KEY, F.concat(F.col("product"), F.lit(" / "), (F.col("ok") % 40).cast("string")).alias("lvl"))
    coded = E.sparse_one_hot(rows, "lvl", materialize(E.level_table(rows, "lvl")), "hot")
    # a sparse vector shows as (size,[place],[1.0])
    shown = F.split(F.regexp_replace(F.col("hot").cast("string"), "[^0-9.]+", " "), " ")
    return coded.select(*SALE_KEY, F.get(shown, F.lit(2)).cast("bigint").alias("place"), F.get(shown, F.lit(1)).cast("bigint").alias("size"))


@query(
    "C7c_time_series_blocks_hot_ties",
    """with r as (select ok, ln, sk, xp, product_id, row_number() over (order by dt, holiday, ok, ln, sk, xp, product_id) r, count(*) over () n from sales), z as (select *, n // 4 z from r)
select ok, ln, sk, xp, product_id, cast(greatest(0, ceil((r - (n - 3*z))/z)) as int) block from z""",
    ("sales",),
)
def c7c(v):
    """A tie-break with two values, so that one of them holds most of a crowded day."""
    rows = v.sales.select(*SALE_KEY, "dt", "holiday")
    return T.time_series_blocks(rows, ["dt", "holiday", "ok", "ln", "sk", "xp", "product_id"], 3, hot_rows=10).drop("dt", "holiday")
