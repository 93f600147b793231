"""Column functions: lenient parsing, calendar parts, rounding and thresholds.

Every function takes a Column or a column name and returns a Column made of built-in expressions.
ANSI mode is on by default, so parsing goes through the ``try_`` family and bad text becomes NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date layouts accepted by default, tried in this order.
DAY_FIRST = ("d-M-yyyy", "d/M/yyyy", "yyyy-MM-dd")
DATE_TEXT = "dd-MM-yyyy"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def slug(c: Column | str, keep: str = "0-9a-z") -> Column:
    """Lower-case identifier: runs of other characters become one underscore, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(F.trim(as_col(c))), f"[^{keep}]+", "_"), F.lit("_"))


def same_text(c: Column | str, value: Column | str) -> Column:
    """Case- and space-blind equality with a literal or another column."""
    other = F.lit(value) if isinstance(value, str) else value
    return F.lower(F.trim(as_col(c))) == F.lower(F.trim(other))


def parse_date(c: Column | str, patterns: Sequence[str] = DAY_FIRST) -> Column:
    """Date from text by the first layout that fits, NULL when none does."""
    text = F.trim(as_col(c))
    return F.coalesce(*[F.try_to_date(text, p) for p in patterns])


def date_text(c: Column | str, original: Column | str | None = None, pattern: str = DATE_TEXT) -> Column:
    """Formatted date; where the date is NULL, the trimmed original text if one is given."""
    out = F.date_format(as_col(c), pattern)
    return out if original is None else F.coalesce(out, F.trim(as_col(original)))


def number(c: Column | str) -> Column:
    """Double from anything, NULL for text that is no number (the text ``nan`` included)."""
    return F.nanvl(as_col(c).try_cast("double"), F.lit(None).cast("double"))


def percent(c: Column | str, scale: float = 1.0) -> Column:
    """``10%`` to 10.0 (scale 1) or 0.1 (scale 100)."""
    return number(F.replace(as_col(c).cast("string"), F.lit("%"), F.lit(""))) / F.lit(float(scale))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(as_col(later), as_col(earlier))


def inclusive_days(start: Column | str, end: Column | str, otherwise: Column | None = None) -> Column:
    """Days from start to end, both counted; then the fallback; then 1."""
    rest = [otherwise.cast("int")] if otherwise is not None else []
    return F.coalesce(days_between(end, start) + 1, *rest, F.lit(1))


def window_end(start: Column | str, days: Column | str) -> Column:
    return F.date_add(as_col(start), as_col(days).cast("int") - 1)


def with_year(d: Column | str, year: Column | str) -> Column:
    """The date moved to another year: unchanged without a year, NULL for 29 Feb in a common year."""
    d, year = as_col(d), as_col(year).cast("int")
    moved = F.try_to_date(F.format_string("%d-%d-%d", year, F.month(d), F.dayofmonth(d)), "y-M-d")
    return F.when(year.isNull() | d.isNull(), d).otherwise(moved)


def date_parts(d: Column | str) -> dict[str, Column]:
    """Weekday with Monday = 0, month and day."""
    d = as_col(d)
    return {"dayofweek": F.weekday(d), "month": F.month(d), "day": F.dayofmonth(d)}


def time_parts(d: Column | str) -> dict[str, Column]:
    """All calendar features; a missing date is neither a month start nor a month end."""
    d = as_col(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "dow": F.weekday(d),
        "weekofyear": F.weekofyear(d),
        "is_month_start": F.coalesce((F.dayofmonth(d) == 1).cast("int"), F.lit(0)),
        "is_month_end": F.coalesce((d == F.last_day(d)).cast("int"), F.lit(0)),
        "quarter": F.quarter(d),
    }


def half_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(as_col(c), digits)


def whole(c: Column | str) -> Column:
    """Nearest integer, ties to even."""
    return F.rint(as_col(c)).cast("int")


def at_least(c: Column | str, threshold: float) -> Column:
    return (as_col(c) >= F.lit(threshold)).cast("int")


def above(c: Column | str, threshold: float) -> Column:
    return (as_col(c) > F.lit(threshold)).cast("int")


def clip(c: Column | str, low: float = 0.0, high: float = 1.0) -> Column:
    """Value held inside [low, high]; NULL stays NULL."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def hash_unit(keys: Sequence[Column | str], seed: int = 42) -> Column:
    """Value in [0, 1) from the md5 of the row key and a seed: the same on every engine and re-run."""
    return hash_word(keys, seed) / F.lit(4294967296.0)


def hash_text(keys: Sequence[Column | str], seed: int = 42) -> Column:
    parts = [F.coalesce(as_col(k).cast("string"), F.lit("~")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def hash_word(keys: Sequence[Column | str], seed: int = 42) -> Column:
    """First 32 bits of the md5 as a non-negative bigint."""
    return F.conv(F.substring(hash_text(keys, seed), 1, 8), 16, 10).cast("bigint")
