"""Order-dependent operators that stay parallel when one group holds much of the data.

A plain ``Window.partitionBy(product)`` puts a product's whole history in one task. A probe job
counts rows per group first. If no group is above the size limit, the ordinary single-shuffle window
runs. Otherwise each hot group is cut into consecutive chunks (day, and inside a crowded day ranges
of an integer tie-break); chunks run in parallel and only the few rows at chunk borders, or the chunk
sizes, meet per group.

A group counts as hot only if it holds more than 1/HOT_LIMIT of the table, so a list of hot groups
(or of crowded days) never exceeds HOT_LIMIT rows, whatever the size of the table. That is the bound
behind what this module collects and broadcasts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.scalars import number
from larder.session import materialize

HOT_ROWS = 2_000_000
HOT_LIMIT = 5_000
BUCKETS_PER_UNIT = 2048


def _all_known(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known


def size_limit(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> float | None:
    """Row limit of an ordinary group: ``hot_rows`` or 1/HOT_LIMIT of the table; None if all groups
    keep it."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    got = sizes.agg(F.sum("_n").alias("total"), F.max("_n").alias("top")).first()
    limit = max(float(hot_rows), (got["total"] or 0) / HOT_LIMIT)
    return limit if (got["top"] or 0) > limit else None


def _small(df: DataFrame) -> DataFrame:
    """A bounded list (hot groups, crowded days, a few buckets), collected once so that all branches of a plan see the same list."""
    return F.broadcast(df.sparkSession.createDataFrame(df.collect(), df.schema))


def hot_groups(df: DataFrame, keys: Sequence[str], limit: float) -> DataFrame:
    """Groups without a NULL key above the limit."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _small(sizes.filter(F.col("_n") > limit).dropna(subset=list(keys)).select(*keys))


def split_hot(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: float) -> DataFrame:
    """Add ``_hot``, ``_day`` and ``_part``: chunk columns that follow ``order`` inside each hot group.

    ``order[0]`` is a date and ``order[1]``, if given, an integer column; the rest only breaks ties.
    Rows with a NULL key belong to no group, so they are spread by hash. With no keys the whole table is
    one hot group. Where a single value of the tie-break holds a crowded day, its rows are a piece of their own, cut
    again by ranges of ``order[2]`` if that is an integer.
    """
    day = order[0]
    if keys:
        hot = hot_groups(df, keys, limit)
        inside = df.join(hot, list(keys), "left_semi")
        tagged = df.join(hot.withColumn("_hot", F.lit(True)), list(keys), "left")
    else:
        inside, tagged = df, df.withColumn("_hot", F.lit(True))
    spread = F.pmod(F.xxhash64(*order), F.lit(4096))
    part = F.when(~_all_known(keys), spread)
    if len(order) > 1:
        tie = order[1]
        crowded = _small(
            inside.filter(F.col(day).isNotNull())
            .groupBy(*keys, day)
            .agg(F.count(F.lit(1)).alias("_n"), F.min(tie).alias("_lo"), F.max(tie).alias("_hi"))
            .filter(F.col("_n") > limit)
            .select(
                *keys, day, F.col("_lo").cast("decimal(38,0)").alias("_lo"),
                F.expr(f"(cast(_hi as decimal(38,0)) - _lo) div ceil(_n / {limit!r}D) + 1").alias("_width"),
            )
        )
        tagged = tagged.join(crowded, [*keys, day], "left")
        step = F.expr(f"(cast(`{tie}` as decimal(38,0)) - _lo) div _width")
        if len(order) > 2 and isinstance(df.schema[order[2]].dataType, T.IntegralType):
            tagged, step = _cut_ties(tagged, inside.join(crowded.select(*keys, day), [*keys, day], "left_semi"), keys, order, limit, step)
        part = part.when(F.col("_hot"), F.coalesce(step, F.lit(-1)))
    else:
        part = part.when(F.col("_hot"), F.lit(0))
    # undated rows form the first chunk, as NULL sorts first
    chunk_day = F.when(F.col("_hot"), F.coalesce(F.col(day), F.lit("0001-01-01").cast("date")))
    return tagged.withColumns({"_day": chunk_day, "_part": part.cast("bigint")}).drop("_lo", "_width", "_ties", "_lo2", "_width2")


def _cut_ties(
    tagged: DataFrame, crowded_rows: DataFrame, keys: Sequence[str], order: Sequence[str], limit: float, step: Column
) -> tuple[DataFrame, Column]:
    """Piece numbers that set apart each tie-break value with more than ``limit`` rows of a crowded day.

    There are at most HOT_LIMIT such values. Inside a range of the tie-break the rows below, at and above such a
    value get growing numbers; those at it are cut by ranges of the next tie-break.
    """
    day, tie, nxt = order[:3]
    cell = [*keys, day, tie]
    held = _small(
        crowded_rows.filter(F.col(tie).isNotNull()).groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(nxt).alias("_lo2"), F.max(nxt).alias("_hi2"))
        .filter(F.col("_n") > limit)
        .select(
            *cell, F.col("_lo2").cast("decimal(38,0)").alias("_lo2"),
            F.expr(f"(cast(_hi2 as decimal(38,0)) - _lo2) div ceil(_n / {limit!r}D) + 1").alias("_width2"),
        )
    )
    ties = F.broadcast(held.groupBy(*keys, day).agg(F.array_sort(F.collect_list(F.col(tie).cast("decimal(38,0)"))).alias("_ties")))
    tagged = tagged.join(ties, [*keys, day], "left").join(held, cell, "left")
    mine = F.col(tie).cast("decimal(38,0)")
    below = F.coalesce(F.size(F.filter("_ties", lambda t: t < mine)), F.lit(0))
    inner = F.coalesce(F.expr(f"(cast(`{nxt}` as decimal(38,0)) - _lo2) div _width2"), F.lit(-1))
    place = F.greatest(below, F.lit(0)) * 2 + F.col("_lo2").isNotNull().cast("int")
    return tagged, (step.cast("bigint") * (2 * HOT_LIMIT + 2) + place) * 1_000_000 + F.when(F.col("_lo2").isNull(), 0).otherwise(inner + 1)


def series_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    features: dict[str, Callable[[object], Column]],
    reach: int,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Window features that look at most ``reach`` rows back, per group, over an ordered series.

    Each feature maps a window specification (partitioned and ordered, no frame) to a Column. Rows with
    a NULL key or date are in no series and get NULL features. In a hot group, rows past the first
    ``reach`` of a chunk are complete inside it. The first and last ``reach`` rows of all its chunks form
    a short series in which the remaining rows have their full past.
    """
    limit = size_limit(df, keys, hot_rows)
    known = _all_known([*keys, order[0]])
    order_cols = [F.asc_nulls_last(order[0]), *[F.col(c) for c in order[1:]]]
    series = Window.partitionBy(*keys).orderBy(*order_cols)
    if limit is None:
        return df.withColumns({name: F.when(known, f(series)) for name, f in features.items()})

    cut = split_hot(df, keys, order, limit)
    chunk = Window.partitionBy(*keys, "_day", "_part")
    local = chunk.orderBy(*order_cols)
    body = cut.withColumns(
        {name: F.when(known, f(local)) for name, f in features.items()} | {"_rn": F.row_number().over(local)}
    ).filter(F.col("_hot").isNull() | ~known | (F.col("_rn") > reach))
    borders = (
        cut.filter(F.col("_hot") & known)
        .withColumns({"_rn": F.row_number().over(local), "_of": F.count(F.lit(1)).over(chunk)})
        .filter((F.col("_rn") <= reach) | (F.col("_of") - F.col("_rn") < reach))
    )
    heads = borders.withColumns({name: f(series) for name, f in features.items()}).filter(F.col("_rn") <= reach)
    out = [*df.columns, *[n for n in features if n not in df.columns]]
    return body.select(*out).unionByName(heads.select(*out))


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    pos: str = "pos",
    total: str = "n",
    hot_rows: int | None = HOT_ROWS,
    chunk: Column | None = None,
) -> DataFrame:
    """Row number from 1 and row count per group, in one shuffle of the table; NULL for a NULL key. Without ``hot_rows``
    no group is looked for that is too large.

    Hot groups are cut as in ``split_hot``, or all groups by an explicit ``chunk`` that follows
    ``order`` (say a hash prefix). A chunk's rows are numbered locally and moved by the sizes of the
    chunks before it; that sum runs over one row per chunk.
    """
    known = _all_known(keys)
    order_cols = [F.col(c) for c in order]
    if chunk is None:
        limit = None if hot_rows is None else size_limit(df, keys, hot_rows) if keys else float(hot_rows)
        if limit is None:
            whole = Window.partitionBy(*keys)
            rank, count = F.row_number().over(whole.orderBy(*order_cols)), F.count(F.lit(1)).over(whole)
            return df.withColumns({pos: F.when(known, rank.cast("bigint")), total: F.when(known, count)})
        cut = split_hot(df, keys, order, limit)
    else:
        cut = df.withColumns({"_hot": F.lit(True), "_day": chunk, "_part": F.lit(0).cast("bigint")})
    place = [*keys, "_day", "_part"]
    sizes = cut.filter(F.col("_hot")).groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_day", "_part").rowsBetween(Window.unboundedPreceding, -1)
    moved = sizes.select(
        *place,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
    )
    local = Window.partitionBy(*place)
    rank = F.row_number().over(local.orderBy(*order_cols))
    # the join and the window share one partitioning; rows of ordinary groups have no chunk and match nothing
    return cut.join(moved, place, "left").withColumns(
        {
            pos: F.when(known, (rank + F.coalesce(F.col("_before"), F.lit(0))).cast("bigint")),
            total: F.when(known, F.coalesce(F.col("_total"), F.count(F.lit(1)).over(local)).cast("bigint")),
        }
    ).select(*df.columns, pos, total)


def value_bucket(df: DataFrame, value: str) -> Column:
    """A coarse key that grows with the value: month of a date, and for numbers equal steps of
    ``sign(x) * log(1 + |x|)``. The number of keys is bounded by the type."""
    c, kind = F.col(value), df.schema[value].dataType
    if isinstance(kind, T.DateType):
        return F.year(c) * 12 + F.month(c)
    c = c.cast("double")
    return F.floor(F.signum(c) * F.log1p(F.abs(c)) * BUCKETS_PER_UNIT)


def text_buckets(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The table with ``_bucket``, a number that grows with the text: Spark samples the texts for range borders, so
    names that share a long prefix are spread like any others. Written, as the borders must hold for all readers."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(tasks, *[F.col(c) for c in [*by, value]])
    return materialize(ranged.withColumn("_bucket", F.spark_partition_id()))


def running_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct non-NULL value: its count ``n``, the rows ``before`` it, the distinct
    values before it (``index``) and the ``total``.

    The table is first reduced to distinct values, so a value held by a third of all rows is one row.
    The running sum works inside value buckets in parallel; only bucket totals meet in one place.
    """
    by = list(by)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    if isinstance(df.schema[value].dataType, T.StringType):
        counts = text_buckets(counts, by, value)
    else:
        counts = counts.withColumn("_bucket", value_bucket(df, value))
    sizes = counts.groupBy(*by, "_bucket").agg(F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_v"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    moved = sizes.select(
        *by,
        "_bucket",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_v").over(earlier), F.lit(0)).alias("_index"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("total"),
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(value)
    past = inside.rowsBetween(Window.unboundedPreceding, -1)
    return counts.join(moved, [*by, "_bucket"]).select(
        *by,
        value,
        "n",
        (F.col("_before") + F.coalesce(F.sum("n").over(past), F.lit(0))).alias("before"),
        (F.col("_index") + F.row_number().over(inside) - 1).alias("index"),
        "total",
    )


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Exact, linearly interpolated quantiles of many columns (columns without values left out).

    Two scans of the columns and hardly any shuffle: counts per value bucket first, then counts per
    value only inside the buckets that hold a wanted rank, at most two per column and probability.
    """
    if not cols:
        return {}
    # a column goes by its number, which is hashed and compared faster than its name
    tall = df.select(F.posexplode(F.array(*[number(c) for c in cols])).alias("column", "value"))
    tall = tall.filter(F.col("value").isNotNull())
    tall = tall.withColumn("_bucket", value_bucket(tall, "value"))

    def wanted(start: Column, size: Column) -> list[Column]:
        hits = []
        for p in probs:
            at = (F.col("total") - 1) * F.lit(float(p))
            hits += [(start <= r) & (r < start + size) for r in (F.floor(at), F.ceil(at))]
        return hits

    sizes = tall.groupBy("column", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("column").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.select(
        "column", "_bucket", "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("column")).alias("total"),
    )
    held = reduce(or_, wanted(F.col("_before"), F.col("_n")))
    buckets = _small(placed.filter(held).drop("_n"))

    counts = tall.join(buckets, ["column", "_bucket"]).groupBy("column", "_bucket", "_before", "total", "value")
    counts = counts.agg(F.count(F.lit(1)).alias("n"))
    past = Window.partitionBy("column", "_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("before", F.col("_before") + F.coalesce(F.sum("n").over(past), F.lit(0)))
    hits = wanted(F.col("before"), F.col("n"))
    picked = ranked.groupBy("column").agg(
        F.max("total").alias("total"), F.array(*[F.max(F.when(h, F.col("value"))) for h in hits]).alias("v")
    )
    out = {}
    for row in picked.collect():
        values = []
        for i, p in enumerate(probs):
            at, low, high = (row["total"] - 1) * float(p), row["v"][2 * i], row["v"][2 * i + 1]
            values.append(low + (high - low) * (at - math.floor(at)))
        out[cols[row["column"]]] = values
    return out


def date_quantile(df: DataFrame, date: str, p: float) -> DataFrame:
    """One row with the interpolated ``p`` quantile of a date, in days since 1970 (column ``cutoff``).

    The aggregate runs over one row per calendar day.
    """
    days = df.filter(F.col(date).isNotNull()).groupBy(F.unix_date(date).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    return days.agg(F.percentile("_d", F.lit(float(p)), F.col("_n")).alias("cutoff"))
