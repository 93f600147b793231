"""Imputation, scaling and category encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.ordered import quantile_values, running_counts


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Exact median of every column, None for an empty one."""
    got = quantile_values(df, cols, [0.5])
    return {c: got[c][0] if c in got else None for c in cols}


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value of every text column, the smallest on ties.

    Counts per value combine before the shuffle; the last step sees one row per distinct value.
    """
    tall = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    counts = tall.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    peak = counts.groupBy("column").agg(F.max("n").alias("n"))
    best = counts.join(peak, ["column", "n"], "left_semi").groupBy("column").agg(F.min("value").alias("value"))
    return dict.fromkeys(cols) | {r["column"]: r["value"] for r in best.collect()}


def numeric_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, dict[str, float | None]]:
    """Median, and mean and population deviation after imputation, of every column: two passes in all."""
    middle = medians(df, cols)
    aggs = []
    for c in cols:
        x = F.coalesce(F.col(c).cast("double"), F.lit(middle[c]).cast("double"))
        aggs += [F.avg(x).alias(f"{c}_mean"), F.stddev_pop(x).alias(f"{c}_std")]
    got = df.agg(*aggs).first()
    return {c: {"median": middle[c], "mean": got[f"{c}_mean"], "std": got[f"{c}_std"]} for c in cols}


def numeric_features(
    df: DataFrame, cols: Sequence[str], scale: bool = True, stats: dict[str, dict] | None = None
) -> DataFrame:
    """Columns imputed by the median and standardised (a constant column becomes 0).

    ``stats`` of the training rows apply the same fit to other rows.
    """
    stats = stats or numeric_stats(df, cols)
    out: dict[str, Column] = {}
    for c in cols:
        fit = stats[c]
        x = F.coalesce(F.col(c).cast("double"), F.lit(fit["median"]).cast("double"))
        out[c] = (x - F.lit(fit["mean"])) / F.lit(fit["std"] or 1.0) if scale else x
    return df.withColumns(out)


def impute_categories(df: DataFrame, cols: Sequence[str], strategy: str = "constant", value: str = "missing") -> DataFrame:
    """NULL categories replaced by a constant or by the most frequent value."""
    best = dict.fromkeys(cols, value) if strategy == "constant" else modes(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(best[c])) for c in cols})


def one_hot(df: DataFrame, col: str, levels: Sequence[object], drop_first: bool = False, names: Sequence[str] | None = None) -> DataFrame:
    """0/1 columns for the fitted levels; an unseen or missing level is 0 everywhere."""
    names = names or [f"{col}_{v}" for v in levels]
    pairs = list(zip(levels, names))[1 if drop_first else 0:]
    return df.withColumns({n: F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)) for v, n in pairs})


def fitted_levels(df: DataFrame, col: str) -> list:
    """Sorted levels of a category, the vocabulary a dummy encoding is fitted on."""
    return [r[0] for r in df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col).toLocalIterator()]


def _sql_value(v: float | None) -> str:
    return "0D" if v is None else f"{float(v)!r}D"


def feature_stages(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    scale: bool = True,
    fill: str | None = "missing",
    output: str = "features",
) -> list:
    """Pipeline stages from raw columns to a feature vector, fitted constants included.

    Imputation and scaling become one SQL statement with the fitted numbers in it, so a saved pipeline
    carries them and scoring stays in generated code. ``fill=None`` imputes the most frequent category.
    """
    items = []
    if numeric:
        stats = numeric_stats(train, numeric) if scale else {c: {"median": m} for c, m in medians(train, numeric).items()}
        for c in numeric:
            fit = stats[c]
            x = f"coalesce(cast(`{c}` as double), {_sql_value(fit['median'])})"
            if scale:
                x = f"({x} - {_sql_value(fit['mean'])}) / {_sql_value(fit['std'] or 1.0)}"
            items.append(f"{x} AS `{c}__num`")
    if categorical:
        best = dict.fromkeys(categorical, fill) if fill is not None else modes(train, categorical)
        for c in categorical:
            text = (best[c] or "missing").replace("\\", "\\\\").replace("'", "\\'")
            items.append(f"coalesce(cast(`{c}` as string), '{text}') AS `{c}__cat`")
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(items)} FROM __THIS__")]
    inputs = [f"{c}__num" for c in numeric]
    if categorical:
        cats = [f"{c}__cat" for c in categorical]
        index = [f"{c}__idx" for c in categorical]
        hot = [f"{c}__hot" for c in categorical]
        stages.append(StringIndexer(inputCols=cats, outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"))
        # the extra level of unseen values is the dropped one, so an unseen value is all zero
        stages.append(OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True))
        inputs += hot
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output))
    return stages


def feature_pipeline(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), **kw) -> Pipeline:
    return Pipeline(stages=feature_stages(train, numeric, categorical, **kw))


def level_table(df: DataFrame, col: str) -> DataFrame:
    """(level, index) of all levels in alphabetical order. Stays a table: no level reaches the driver."""
    text = df.select(F.col(col).cast("string").alias("level"))
    return running_counts(text, "level").select("level", F.col("index").cast("bigint").alias("index"))


def level_index(df: DataFrame, col: str, levels: DataFrame, out: str) -> DataFrame:
    """Rows with the index of their level, by a join: NULL for an unseen or missing one. A level that holds much of the
    table makes one skewed partition, which Spark splits; a small dictionary is broadcast by its measured size."""
    names = levels.select(F.col("level").alias("_level"), F.col("index").alias(out))
    return df.join(names, F.col(col).cast("string") == F.col("_level"), "left").drop("_level")


def sparse_one_hot(df: DataFrame, col: str, levels: DataFrame, out: str, drop_first: bool = False) -> DataFrame:
    """A sparse 0/1 vector per row with a place for each fitted level (the first left out on request). Unseen and missing
    levels are all zero. The plan has one join and one encoder however many levels there are."""
    size = levels.count() - drop_first
    place = f"_{out}_place"
    at = F.col(place) - int(drop_first)
    rows = level_index(df, col, levels, place)
    # the place behind the last is the one that the encoder drops
    rows = rows.withColumn(place, F.when(at >= 0, at).otherwise(F.lit(size)).cast("double"))
    rows = rows.withColumn(place, F.coalesce(place, F.lit(float(size))))
    attributes = {"ml_attr": {"type": "nominal", "num_vals": size + 1, "name": place}}
    named = rows.withColumn(place, F.col(place).alias(place, metadata=attributes))
    encoder = OneHotEncoder(inputCols=[place], outputCols=[out], dropLast=True).fit(named)
    return encoder.transform(named).drop(place)
