"""Event calendar: loading, expansion to days, joins with sales, durations and forecast windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import (
    as_col, date_text, inclusive_days, number, parse_date, window_end, with_year,
)
from larder.operators.clean import (
    EVENT_END_NAMES, EVENT_NAMES, EVENT_START_NAMES, EXPIRY_NAMES, canonical_name, conform, detect,
    drop_undated, find_date_column, normalize_columns, valid_intervals,
)
from larder.operators.ordered import positions

# Header names accepted by the strict calendar loader, tried in this order.
CALENDAR_NAMES = {
    "event_name": ("holidays_event", "event_name", "event", "holiday", "holidays", "holidays_event_name"),
    "start_date": ("start_date", "start", "start_dt", "from_date", "from", "startdate"),
    "end_date": ("end_date", "end", "end_dt", "to_date", "to", "enddate"),
    "duration_days": (
        "duration_days", "duration", "duration_in_days", "duration__days", "duration_days_", "days", "no_of_days",
    ),
    "year": ("year",),
}
EVENT_SALES_COLUMNS = (
    "date", "product_id", "product", "category", "quantity_sold", "expiry_date", "unit_price",
    "discount", "discount_price", "shelf_life", "holiday", "event", "event_name",
)


def load_calendar(raw: DataFrame, keep: tuple[str, ...] = (), bad_start: str = "error") -> DataFrame:
    """Canonical calendar: trimmed name, dates (moved to ``year`` if given) and inclusive duration.

    A start date that cannot be read fails the job when the row is computed (``bad_start='error'``) or
    drops the row (``'drop'``). Without an end date the end follows from the duration.
    """
    found = {}
    headers = {canonical_name(c, ascii_only=False): c for c in raw.columns}
    for role, names in CALENDAR_NAMES.items():
        match = detect(list(headers), names, substring=False)
        found[role] = F.col(f"`{headers[match]}`") if match else None
    if found["event_name"] is None or found["start_date"] is None:
        raise ValueError(f"a calendar needs an event name and a start date, got {raw.columns}")

    start = parse_date(found["start_date"])
    end = parse_date(found["end_date"]) if found["end_date"] is not None else F.lit(None).cast("date")
    if found["year"] is not None:
        year = number(found["year"]).cast("int")
        start, end = with_year(start, year), with_year(end, year)
    given = number(found["duration_days"]) if found["duration_days"] is not None else F.lit(None).cast("double")
    out = raw.select(
        *keep,
        F.trim(found["event_name"].cast("string")).alias("event_name"),
        start.alias("start_date"),
        end.alias("_end"),
        given.alias("_given"),
    )
    if bad_start == "drop":
        out = out.filter(F.col("start_date").isNotNull())
    else:
        message = F.concat(F.lit("calendar row without a readable start date: "), F.coalesce("event_name", F.lit("?")))
        out = out.withColumn(
            "start_date", F.when(F.col("start_date").isNull(), F.raise_error(message).cast("date")).otherwise(F.col("start_date"))
        )
    out = out.withColumn("duration_days", inclusive_days("start_date", "_end", F.col("_given")))
    return out.select(
        *keep,
        "event_name",
        "start_date",
        F.coalesce("_end", window_end("start_date", "duration_days")).alias("end_date"),
        "duration_days",
    )


def event_days(cal: DataFrame, start: str = "start_date", end: str = "end_date", day: str = "day") -> DataFrame:
    """One row per event and covered day. The filter stays below the explode: a reversed interval
    would make ``sequence`` fail."""
    span = F.when(F.col(start) <= F.col(end), F.sequence(start, end, F.expr("interval 1 day")))
    return valid_intervals(cal, start, end).withColumn(day, F.explode(span))


def join_calendar(sales: DataFrame, cal: DataFrame, date: str = "date") -> DataFrame:
    """One row per sale and event covering its day: the calendar becomes days, the join an equi join."""
    days = event_days(cal).select(F.col("day").alias("_day"), "event_name")
    return sales.join(days, F.col(date) == F.col("_day")).drop("_day")


def join_calendar_interval(sales: DataFrame, cal: DataFrame, date: str = "date") -> DataFrame:
    """The same rows for long intervals: meet on the calendar month, then check the interval."""
    month = F.trunc("start_date", "MM"), F.trunc("end_date", "MM")
    spans = valid_intervals(cal, "start_date", "end_date").select(
        "event_name",
        "start_date",
        "end_date",
        F.explode(F.sequence(*month, F.expr("interval 1 month"))).alias("_month"),
    )
    covered = F.col(date).between(F.col("start_date"), F.col("end_date"))
    return sales.join(spans, (F.trunc(date, "MM") == F.col("_month")) & covered).drop("_month", "start_date", "end_date")


def sales_with_events(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Raw sales and raw calendar to the thirteen output columns, dates as text, absent columns blank."""
    sales, events = normalize_columns(sales), normalize_columns(events)
    date = find_date_column(sales)
    name, start, end = (detect(events.columns, n) for n in (EVENT_NAMES, EVENT_START_NAMES, EVENT_END_NAMES))
    if (not start or not end) and "date" in events.columns:
        start = end = "date"
    if not start or not end:
        raise ValueError("event start and end columns not found")
    cal = drop_undated(
        events.select(
            (F.col(name) if name else F.lit("Unnamed Event")).alias("event_name"),
            parse_date(F.col(start).cast("string")).alias("start_date"),
            parse_date(F.col(end).cast("string")).alias("end_date"),
        ),
        "start_date",
        "end_date",
    )
    expiry = detect(sales.columns, EXPIRY_NAMES)
    dated = drop_undated(sales.withColumn("_date", parse_date(F.col(date).cast("string"))), "_date")
    shown = F.lit("")
    if expiry:
        text = F.col(expiry).cast("string")
        shown = date_text(parse_date(text), text)
    joined = join_calendar(dated.drop("event_name"), cal, "_date")
    return conform(joined.withColumn("expiry_date", shown).withColumn("date", date_text("_date")), EVENT_SALES_COLUMNS, "blank")


def typical_duration(cal: DataFrame) -> DataFrame:
    """Most frequent duration per event (the shortest on ties), keyed by the lower-case name.

    Counts per duration come first, so the final step sees one row per event and distinct duration.
    """
    counts = cal.groupBy(F.lower(F.trim("event_name")).alias("event_key"), "duration_days").agg(
        F.count(F.lit(1)).alias("_n")
    )
    best = F.max_by("duration_days", F.struct("_n", -F.col("duration_days")))
    return counts.groupBy("event_key").agg(best.alias("duration_days"))


def event_windows(cal: DataFrame, row_id: str = "row_id", **kw) -> DataFrame:
    """Occurrences numbered from 1 per event by start date."""
    keyed = cal.withColumn("event_key", F.lower(F.trim("event_name")))
    return positions(keyed, ["event_key"], ["start_date", row_id], pos="window_index", total="_n", **kw).drop("_n")


def add_days(df: DataFrame, start, end, day: str = "date") -> DataFrame:
    """Each row once per day of its own interval; a narrow operation."""
    return df.withColumn(day, F.explode(F.sequence(as_col(start), as_col(end), F.expr("interval 1 day"))))
