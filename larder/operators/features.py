"""Series features, label codes, ranks and bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import as_col, date_parts, time_parts
from larder.operators.ordered import HOT_ROWS, quantile_values, running_counts, series_features

LAGS = (1, 7, 28)
ROLLS = (7, 28)


def add_time_parts(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns(time_parts(date))


def add_date_parts(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns(date_parts(date))


def add_lag_rolling(
    df: DataFrame,
    ids: Sequence[str],
    order: Sequence[str],
    target: str,
    lags: Sequence[int] = LAGS,
    rolls: Sequence[int] = ROLLS,
    exclude_current: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Lags by rows and rolling means per id, NULL while fewer than half the window is filled.

    ``order`` is the date, an integer tie-break and further tie-breaks. ``exclude_current`` ends the
    mean at the previous row, so that a row's features never contain its own target.
    """
    if not ids or not order:
        return df

    def lag(rows: int):
        return lambda w: F.lag(target, rows).over(w)

    def mean(width: int):
        first, last = (-width, -1) if exclude_current else (1 - width, 0)

        def build(w) -> Column:
            frame = w.rowsBetween(first, last)
            return F.when(F.count(target).over(frame) >= max(1, width // 2), F.avg(target).over(frame))

        return build

    features = {f"lag_{target}_{n}": lag(n) for n in lags} | {f"rmean_{target}_{n}": mean(n) for n in rolls}
    return series_features(df, ids, order, features, max([*lags, *rolls, 1]), hot_rows)


def add_lag_rolling_future(
    future: DataFrame,
    history: DataFrame,
    ids: Sequence[str],
    order: Sequence[str],
    target: str,
    **kw,
) -> DataFrame:
    """The same features for rows without a target yet, their past taken from the history: one union
    and one pass over the series, no join back."""
    both = history.withColumn("is_future", F.lit(False)).unionByName(
        future.withColumn("is_future", F.lit(True)), allowMissingColumns=True
    )
    return add_lag_rolling(both, ids, order, target, **kw).filter("is_future").drop("is_future")


def last_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Attributes of each group's last row in order, NULL values kept; combines before the shuffle."""
    last = F.max_by(F.struct(*cols), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*")


def code_table(df: DataFrame, col: str, code: str = "code") -> DataFrame:
    """Distinct values and their alphabetical code from 0."""
    return running_counts(df, col).select(col, F.col("index").cast("int").alias(code))


def label_codes(df: DataFrame, col: str, code: str | None = None) -> DataFrame:
    """Rows with the alphabetical code of a column."""
    code = code or f"{col}_enc"
    return df.join(code_table(df, col, code), col, "left")


# Names that mean no event.
QUIET_EVENTS = ("none", "nan", "")


def fallback_event(codes: DataFrame, name: str = "event_name", code: str = "code") -> tuple[int, str | None]:
    """Code and name an event never seen is scored as: ``none``, or code 0 if there is no ``none``."""
    few = {r[name]: r[code] for r in codes.filter((F.col(name) == "none") | (F.col(code) == 0)).select(name, code).collect()}
    if "none" in few:
        return few["none"], "none"
    return 0, next(iter(few), None)


def event_codes(requested: DataFrame, codes: DataFrame, name: str = "event_name", code: str = "code") -> DataFrame:
    """Code, active flag and canonical name of requested events.

    ``codes`` holds lower-case names and codes. An event never seen takes the fallback code and counts
    as active.
    """
    number, unseen = fallback_event(codes, name, code)
    known = codes.select(F.col(name).alias("_key"), F.col(code).alias("_code"))
    keyed = requested.withColumn("event_key", F.lower(F.trim(as_col(name))))
    joined = keyed.join(known, F.col("event_key") == F.col("_key"), "left")
    quiet = F.col("_code").isNotNull() & F.col("event_key").isin(*QUIET_EVENTS)
    return joined.withColumns(
        {
            "event_code": F.coalesce("_code", F.lit(number)),
            "event_flag": F.when(quiet, F.lit(0.0)).otherwise(F.lit(1.0)),
            "canonical_name": F.coalesce("_key", F.lit(unseen), "event_key"),
        }
    ).drop("_key", "_code")


def event_code(codes: DataFrame, event: str, name: str = "event_name", code: str = "code") -> tuple[int, float]:
    """Code and active flag of one event."""
    key = event.strip().lower()
    near = codes.filter(F.col(name).isin(key, "none")).select(name, code)
    few = {r[name]: r[code] for r in near.collect()}
    if key in few:
        return few[key], 0.0 if key in QUIET_EVENTS else 1.0
    return few.get("none", 0), 1.0


def percent_rank_average(df: DataFrame, col: str, out: str = "pct") -> DataFrame:
    """Rank share in (0, 1], ties at their average rank: counts per value, then a join on the value."""
    ranks = running_counts(df, col).select(
        col, ((F.col("before") + (F.col("n") + 1) / 2) / F.col("total")).alias(out)
    )
    return df.join(ranks, col, "left")


def quantile_edges(df: DataFrame, col: str, q: int, digits: int = 9) -> list[float]:
    """Distinct edges of q quantile bins, at most q + 1 numbers."""
    got = quantile_values(df, [col], [i / q for i in range(q + 1)]).get(col, [])
    return sorted({round(e, digits) for e in got})


def bin_index(value: Column, edges: Sequence[float], digits: int = 9) -> Column:
    """Right-closed bin from 0, the lowest edge in the first bin; NULL when there is no bin at all."""
    if len(edges) < 2:
        return F.lit(None).cast("int")
    x = F.round(value, digits)
    below = sum(((F.lit(e) < x).cast("int") for e in edges), F.lit(0))
    return F.when(value.isNotNull(), F.greatest(below - 1, F.lit(0)))


def qcut(df: DataFrame, col: str, q: int = 5, out: str = "bin") -> DataFrame:
    """Quantile bins with duplicate edges dropped; with fewer than two bins, half as many are tried."""
    edges = quantile_edges(df, col, q)
    if len(edges) < 3:
        edges = quantile_edges(df, col, max(2, q // 2))
    chosen = bin_index(F.col(col).cast("double"), edges)
    return df.withColumn(out, F.coalesce(chosen, F.lit(0)).cast("int"))


def quantile_classes(df: DataFrame, col: str, q: int, out: str) -> DataFrame:
    """Quantile bins without the fallback, as used for class metrics."""
    chosen = bin_index(F.col(col).cast("double"), quantile_edges(df, col, q))
    return df.withColumn(out, F.coalesce(chosen, F.lit(0)).cast("int"))


def equal_width_bins(df: DataFrame, col: str, q: int, out: str = "bin") -> DataFrame:
    """Bins of equal width between the smallest and largest value, right-closed, the minimum in bin 0.

    If all values are equal the range is widened by a thousandth on both sides.
    """
    low, high = df.agg(F.min(col), F.max(col)).first()
    if low is None:
        return df.withColumn(out, F.lit(None).cast("int"))
    if low == high:
        widen = 0.001 * abs(low) if low else 0.001
        low, high = low - widen, high + widen
    step = (high - low) / q
    below = sum(((F.lit(float(low + i * step)) < F.col(col)).cast("int") for i in range(q)), F.lit(0))
    return df.withColumn(out, F.when(F.col(col).isNotNull(), F.greatest(below - 1, F.lit(0))).cast("int"))
