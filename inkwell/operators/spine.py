"""Day spines and as-of counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def day_range(events: DataFrame, day: str = "event_date_dt") -> DataFrame:
    """One row: first and last day with events."""
    return events.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def day_spine(bounds: Column, spark: SparkSession) -> DataFrame:
    """One row per day between the two days of ``bounds``."""
    days = F.sequence(bounds["first_day"], bounds["last_day"], F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("as_of_date"))


def as_of_counts(bounds: DataFrame, rows: DataFrame, dates: Mapping[str, Column]) -> DataFrame:
    """For each day of the spine, how many rows have each date on or before it.

    Rows are reduced to counts per day first; only these day counts, one row per
    calendar day, meet in the running sum. Dates before the spine count from its first
    day on.
    """
    marks = F.array(*[F.struct(F.lit(n).alias("name"), d.alias("day")) for n, d in dates.items()])
    # The same subquery each time, so Spark computes it once.
    limits = bounds.select(F.struct("first_day", "last_day")).scalar()
    first, last = limits["first_day"], limits["last_day"]
    per_day = (
        rows.select(F.explode(marks).alias("mark"))
        .select("mark.name", F.greatest(F.col("mark.day"), first).alias("as_of_date"), "mark.day")
        .filter(F.col("day").isNotNull() & (F.col("day") <= last))
        .groupBy("as_of_date")
        .agg(*[F.count_if(F.col("name") == n).alias(f"_{n}") for n in dates])
    )
    # One row per calendar day, so this unpartitioned window stays tiny.
    to_date = Window.orderBy("as_of_date").rowsBetween(Window.unboundedPreceding, 0)
    totals = [F.coalesce(F.sum(f"_{n}").over(to_date), F.lit(0)).cast("bigint").alias(n) for n in dates]
    return day_spine(limits, bounds.sparkSession).join(per_day, "as_of_date", "left").select("as_of_date", *totals)
