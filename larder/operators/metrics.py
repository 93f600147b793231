"""Regression and classification metrics as aggregates: partial sums per task, one row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import clip, same_text

REGRESSION = ("MAE", "RMSE", "R2", "MAPE")


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2 and MAPE (percent, zero actuals left out).

    R2 is NULL for one row; with constant actuals it is 1 for a perfect fit and 0 otherwise.
    """
    t, e = F.col(y).cast("double"), F.col(y).cast("double") - F.col(p).cast("double")
    kept = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    sums = kept.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("MAE"),
        F.avg(e * e).alias("_mse"),
        F.var_pop(t).alias("_var"),
        (F.avg(F.when(t != 0, F.abs(e / F.nullif(t, F.lit(0.0))))) * 100).alias("MAPE"),
    )
    constant = F.when(F.col("_mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    r2 = F.when(F.col("n") < 2, F.lit(None)).when(F.col("_var") == 0, constant).otherwise(1 - F.col("_mse") / F.col("_var"))
    return sums.select(*by, "n", "MAE", F.sqrt("_mse").alias("RMSE"), r2.alias("R2"), "MAPE")


def event_metrics(df: DataFrame, requested: DataFrame, y: str, p: str, by: Sequence[str], event: str) -> DataFrame:
    """Metrics of one event's rows for every requested group, NULL where the group has none."""
    key = "_event_key"
    rows = df.withColumn(key, F.lower(F.trim(event)))
    found = regression_metrics(rows, y, p, [*by, key])
    asked = requested.withColumn(key, F.lower(F.trim(event)))
    return asked.join(found, [*by, key], "left").drop(key).withColumn("n", F.coalesce("n", F.lit(0)))


def event_rows(df: DataFrame, event: str, name: str) -> DataFrame:
    return df.filter(same_text(event, name))


def normalized_accuracy(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """1 - MAE / mean absolute actual, held inside [0, 1]."""
    sums = df.groupBy(*by).agg(F.avg(F.abs(F.col(y) - F.col(p))).alias("_mae"), F.avg(F.abs(F.col(y))).alias("_scale"))
    return sums.select(*by, clip(1 - F.col("_mae") / (F.col("_scale") + 1e-8)).alias("accuracy"))


def _pairs(df: DataFrame, true: str, pred: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by, F.col(true).alias("true"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, true: str, pred: str, labels: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """Confusion matrix in long form, empty cells included; one map of at most labels^2 cells per group."""
    cells = _pairs(df, true, pred, by).withColumn("_cell", F.struct("true", "pred"))
    table = cells.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_cell", "n"))).alias("_m"))
    names = F.array(*[F.lit(int(x)) for x in labels])
    grid = table.withColumn("true", F.explode(names)).withColumn("pred", F.explode(names))
    count = F.try_element_at("_m", F.struct(F.col("true"), F.col("pred")))
    return grid.select(*by, "true", "pred", F.coalesce(count, F.lit(0)).alias("n"))


def class_report(df: DataFrame, true: str, pred: str, by: Sequence[str] = (), labels: Sequence[int] = ()) -> DataFrame:
    """Support, precision, recall and F1 per class found in truth or prediction (or listed); 0 for 0/0."""
    pairs = _pairs(df, true, pred, by)
    hit = F.when(F.col("true") == F.col("pred"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")

    def part(label: Column, support: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            label.cast("int").alias("label"), support.cast("bigint").alias("s"),
            predicted.cast("bigint").alias("p"), hits.cast("bigint").alias("h"),
        )

    parts = [part(F.col("true"), F.col("n"), zero, hit), part(F.col("pred"), zero, F.col("n"), zero)]
    parts += [part(F.lit(int(x)), zero, zero, zero) for x in labels]
    counts = pairs.select(*by, F.explode(F.array(*parts)).alias("c")).groupBy(*by, F.col("c.label").alias("label")).agg(
        F.sum("c.s").alias("support"), F.sum("c.p").alias("predicted"), F.sum("c.h").alias("hits")
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    scored = counts.withColumns(
        {"precision": ratio(F.col("hits"), F.col("predicted")), "recall": ratio(F.col("hits"), F.col("support"))}
    )
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.withColumn("f1", f1)


def class_summary(report: DataFrame, by: Sequence[str] = (), labels: Sequence[int] = ()) -> DataFrame:
    """Accuracy and macro means over a ``class_report``.

    Accuracy looks at the matrix over the listed labels, or over the true classes when none are listed,
    so a prediction outside those labels leaves it.
    """
    inside = F.col("label").isin([int(x) for x in labels]) if labels else F.col("support") > 0
    matrix = F.sum(F.when(inside, F.col("predicted")))
    hits = F.sum(F.when(inside, F.col("hits")))
    return report.groupBy(*by).agg(
        F.coalesce(F.try_divide(hits.cast("double"), matrix.cast("double")), F.lit(0.0)).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )


def residuals(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.withColumn("residual", F.col(y) - F.col(p))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Counts in equal bins between minimum and maximum; the maximum belongs to the last bin."""
    low, high = df.agg(F.min(col), F.max(col)).first()
    if low is not None and low == high:
        # a constant column gets the unit range around its value
        low, high = low - 0.5, high + 0.5
    place = F.least(F.lit(bins), F.width_bucket(F.col(col), F.lit(low), F.lit(high), F.lit(bins)))
    return df.filter(F.col(col).isNotNull()).groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def fold_means(folds: DataFrame, by: Sequence[str] = ("model",), error: str = "error") -> DataFrame:
    """Mean metrics over the folds without an error, and how many those are."""
    ok = F.col(error).isNull()
    means = [F.avg(F.when(ok, F.col(m))).alias(m) for m in ("MAE", "RMSE", "R2")]
    return folds.groupBy(*by).agg(*means, F.count(F.when(ok, F.lit(1))).alias("folds"))


def window_span(df: DataFrame, by: Sequence[str], start: str = "window_start", end: str = "window_end") -> DataFrame:
    return df.groupBy(*by).agg(F.min(start).alias(start), F.max(end).alias(end))


def top(df: DataFrame, by: str, k: int) -> DataFrame:
    """The k largest rows: a bounded heap per task, no global sort."""
    return df.orderBy(F.desc(by)).limit(k)
