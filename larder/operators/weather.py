"""Sales with the weather of their day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DROPPED = ("customer_type", "payment")


def join_weather(sales: DataFrame, weather: DataFrame, date: str = "date") -> DataFrame:
    """Left join on the day; an undated sale meets an undated weather row. No hint: one row per day is
    small, so Spark broadcasts it by its measured size, and a busy day is split by the skew rule if not."""
    right = weather.withColumnRenamed(date, "_day")
    return sales.join(right, F.col(date).eqNullSafe(F.col("_day")), "left").drop("_day", *DROPPED)
