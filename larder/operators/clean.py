"""Column-name handling, filters and defaults applied before any join or window."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.scalars import DAY_FIRST, as_col, number, parse_date, percent

# Names accepted for each role, tried in this order.
SALES_DATE_NAMES = ("date", "sales_date", "order_date", "invoice_date", "txn_date", "transaction_date", "day", "ds")
EXPIRY_NAMES = ("expiry_date", "expiry", "exp_date")
EVENT_NAMES = (
    "event", "events", "event_name", "holiday", "holidays", "holiday_name", "holidays_event",
    "name", "title", "festival", "description",
)
EVENT_START_NAMES = ("start_date", "start", "from", "begin", "date_start")
EVENT_END_NAMES = ("end_date", "end", "to", "finish", "date_end")

DATE_SHARE = 0.8


def canonical_name(name: str, ascii_only: bool = True) -> str:
    """Identifier form of a header: its runs of letters and digits, joined by single underscores."""
    runs = "[0-9a-z]+" if ascii_only else r"[^\W_]+"
    return "_".join(re.findall(runs, str(name).lower()))


def normalize_columns(df: DataFrame, ascii_only: bool = True) -> DataFrame:
    return df.toDF(*[canonical_name(c, ascii_only) for c in df.columns])


def detect(columns: Sequence[str], candidates: Sequence[str], substring: bool = True) -> str | None:
    """First candidate that is a column; else the first column containing any candidate."""
    exact = [c for c in candidates if c in columns]
    partial = [c for c in columns if any(k in c for k in candidates)] if substring else []
    return (exact + partial + [None])[0]


def parse_rates(df: DataFrame, columns: Sequence[str] | None = None, patterns: Sequence[str] = DAY_FIRST) -> DataFrame:
    """Share of rows that read as a date, for all columns in one pass."""
    columns = list(columns or df.columns)
    return df.agg(*[F.avg(parse_date(F.col(c).cast("string"), patterns).isNotNull().cast("double")).alias(c) for c in columns])


def find_date_column(df: DataFrame, candidates: Sequence[str] = SALES_DATE_NAMES, share: float = DATE_SHARE) -> str:
    """Date column by name, or the first one with enough parseable values; ``ValueError`` if none."""
    named = detect(df.columns, candidates)
    if named:
        return named
    rates = parse_rates(df).first()
    for c in df.columns:
        if (rates[c] or 0.0) >= share:
            return c
    raise ValueError("no date column found")


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")
    return df


def conform(df: DataFrame, order: Sequence[str], missing: str = "skip") -> DataFrame:
    """Columns in the given order; absent ones are skipped, added as NULL or added as empty text."""
    if missing == "skip":
        return df.select(*[c for c in order if c in df.columns])
    filler = F.lit(None).cast("string") if missing == "null" else F.lit("")
    return df.select(*[F.col(c) if c in df.columns else filler.alias(c) for c in order])


def align(df: DataFrame, columns: Sequence[str], fill: float | None = None) -> DataFrame:
    """Exactly the fitted feature columns, absent ones filled with one value."""
    filler = F.lit(fill).cast("double")
    return df.select(*[F.col(c) if c in df.columns else filler.alias(c) for c in columns])


def drop_undated(df: DataFrame, *dates: str) -> DataFrame:
    return df.dropna(subset=list(dates))


def valid_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.filter(F.col(start) <= F.col(end))


def numeric_target(df: DataFrame, target: str) -> DataFrame:
    """Rows whose target reads as a number, with the target as double."""
    return df.withColumn(target, number(F.col(target))).filter(F.col(target).isNotNull())


def min_history(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """Rows of groups with at least ``n`` rows: partial counts and a semi join, no window over the group."""
    enough = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= n).select(*keys)
    return df.join(enough, list(keys), "left_semi")


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if c in df.columns})


def default_columns(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add constant columns the table does not have."""
    return df.withColumns({c: F.lit(v) for c, v in values.items() if c not in df.columns})


def roles(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and other columns by type, the excluded ones (target, date) left out."""
    numeric, other = [], []
    for f in df.schema.fields:
        if f.name not in exclude:
            (numeric if isinstance(f.dataType, (T.NumericType, T.BooleanType)) else other).append(f.name)
    return numeric, other


def typed_sales(raw: DataFrame, discount_scale: float = 100.0, patterns: Sequence[str] = DAY_FIRST) -> DataFrame:
    """The canonical sales table from text columns: dates, numbers, discount share and 0/1 flags."""
    casts: dict[str, Column] = {}
    for c in ("date", "expiry_date"):
        if c in raw.columns:
            casts[c] = parse_date(c, patterns)
    for c in ("quantity_sold", "unit_price", "discount_price", "shelf_life", "total"):
        if c in raw.columns:
            casts[c] = number(c)
    if "discount" in raw.columns:
        casts["discount"] = percent("discount", discount_scale)
    for c in ("holiday", "event"):
        if c in raw.columns:
            casts[c] = F.coalesce(number(c), F.lit(0.0)).cast("int")
    return raw.withColumns(casts)


def ceil_share(n: Column | str, share: Column | float) -> Column:
    """Rows in a share of n, rounded up (a tiny slack keeps 0.1 * 30 at 3)."""
    share = F.lit(share) if isinstance(share, float) else share
    return F.ceil(as_col(n) * share - F.lit(1e-9))
