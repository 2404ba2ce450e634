"""Metric queries over the cubes and the shapes built from them (MQ1 to MQ11)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.plans.actives import active
from inkwell.plans.cubes import CUBES, Cube
from inkwell.plans.warehouse import Warehouse

MISSING_NAME = "—"


@dataclass(frozen=True)
class DateRange:
    """First and last day, both included."""

    first: dt.date
    last: dt.date

    @classmethod
    def of(cls, first: str, last: str) -> DateRange:
        return cls(dt.date.fromisoformat(first), dt.date.fromisoformat(last))

    def last_day(self) -> DateRange:
        return DateRange(self.last, self.last)

    def covers(self, column: Column) -> Column:
        """Plain comparisons of the bare column, for dates and timestamps alike, so that
        they reach the partitions and the Parquet statistics."""
        return (column >= F.lit(self.first)) & (column < F.lit(self.last + dt.timedelta(days=1)))


def grain_for(range_: DateRange) -> str:
    """Grain that keeps a chart readable (MQ2)."""
    days = (range_.last - range_.first).days
    return "day" if days <= 31 else "week" if days <= 120 else "month"


@dataclass(frozen=True)
class MetricQuery:
    """Members are written ``cube.member``, and all belong to one cube.

    With a ``grain`` the result has a row per bucket of the time dimension, in a column
    of that dimension's name; without one the time dimension only filters.
    """

    measures: Sequence[str]
    dimensions: Sequence[str] = ()
    time_dimension: str | None = None
    grain: str | None = None
    order_by: str | None = None
    limit: int | None = None


def _member(name: str) -> str:
    return name.split(".", 1)[1]


def metric_query(w: Warehouse, query: MetricQuery, range_: DateRange | None = None) -> DataFrame:
    """Rows of a metric query (MQ1): one filter, one grouping, an optional top-k."""
    cube_names = {name.split(".", 1)[0] for name in (*query.measures, *query.dimensions)}
    if query.time_dimension:
        cube_names.add(query.time_dimension.split(".", 1)[0])
    if len(cube_names) != 1:
        raise ValueError(f"members of one cube expected, got {sorted(cube_names)}")
    cube = CUBES[cube_names.pop()]
    if any(_member(m) in cube.actives for m in query.measures) and not query.dimensions:
        return _with_actives(w, cube, query, range_)
    rows = cube.relation(w)
    keys = [F.col(cube.dimensions[_member(d)]).alias(_member(d)) for d in query.dimensions]
    if query.time_dimension:
        time = F.col(cube.dimensions[_member(query.time_dimension)])
        if range_ is not None:
            rows = rows.filter(range_.covers(time))
        if query.grain:
            bucket = F.date_trunc(query.grain, time).cast("date")
            keys.append(bucket.alias(_member(query.time_dimension)))
    values = [cube.measures[_member(m)]().alias(_member(m)) for m in query.measures]
    result = rows.groupBy(*keys).agg(*values)
    if query.order_by:
        # Names settle equal values, so that a limit keeps the same rows in every run.
        names = [F.col(_member(d)).asc() for d in query.dimensions]
        result = result.orderBy(F.col(_member(query.order_by)).desc(), *names)
    return result.limit(query.limit) if query.limit else result


def _with_actives(w: Warehouse, cube: Cube, query: MetricQuery, range_: DateRange | None) -> DataFrame:
    """A query over time alone: its distinct clients and logins come from the days' bitmaps."""
    distinct = [m for m in query.measures if _member(m) in cube.actives]
    others = [m for m in query.measures if m not in distinct]
    days = w.table("activity_bitmaps")
    if range_ is not None and query.time_dimension:
        days = days.filter(range_.covers(F.col("event_date")))
    who = list(dict.fromkeys(cube.actives[_member(m)] for m in distinct))
    named = [F.col(cube.actives[_member(m)]).alias(_member(m)) for m in distinct]
    order = [_member(m) for m in query.measures]
    rows = cube.relation(w)
    values = [cube.measures[_member(m)]().alias(_member(m)) for m in others] or [F.count(F.lit(1)).alias("_rows")]
    if not query.grain:
        if not others:
            return active(days, who).select(*named).select(*order)
        if range_ is not None and query.time_dimension:
            rows = rows.filter(range_.covers(F.col(cube.dimensions[_member(query.time_dimension)])))
        counts = active(days, who).select(F.struct(*named)).scalar()
        both = rows.agg(*values).withColumn("_actives", counts)
        return both.select(*[F.col("_actives")[c].alias(c) if c in {_member(m) for m in distinct} else c for c in order])
    day = _member(query.time_dimension)
    time = F.col(cube.dimensions[day])
    if range_ is not None:
        rows = rows.filter(range_.covers(time))
    grouped = rows.groupBy(F.date_trunc(query.grain, time).cast("date").alias(day)).agg(*values)
    bucket = F.date_trunc(query.grain, F.col("event_date")).cast("date")
    counts = active(days, who, bucket).select(F.col("at").alias(day), *named)
    result = grouped.join(counts, day, "left").fillna(0, [_member(m) for m in distinct]).select(day, *order)
    if query.order_by:
        result = result.orderBy(F.col(_member(query.order_by)).desc(), F.col(day).asc())
    return result.limit(query.limit) if query.limit else result


def total(w: Warehouse, query: MetricQuery, range_: DateRange) -> DataFrame:
    """Single row of totals, null where nothing matched (MQ3)."""
    return metric_query(w, query, range_)


def _named(series: Mapping[str, str]) -> list[Column]:
    return [F.coalesce(F.col(_member(m)), F.lit(0)).alias(name) for m, name in series.items()]


def trend(w: Warehouse, query: MetricQuery, series: Mapping[str, str], range_: DateRange) -> DataFrame:
    """Time series with a column per measure (MQ4)."""
    rows = metric_query(w, query, range_)
    day = F.col(_member(query.time_dimension)).alias("date")
    return rows.select(day, *_named(series)).orderBy("date")


def breakdown(
    w: Warehouse, query: MetricQuery, name: str, value: str, range_: DateRange, limit: int | None = None
) -> DataFrame:
    """Names and values, largest first (MQ5)."""
    rows = metric_query(w, query, range_).select(
        F.coalesce(F.col(_member(name)).cast("string"), F.lit(MISSING_NAME)).alias("name"),
        F.coalesce(F.col(_member(value)), F.lit(0)).alias("value"),
    )
    rows = rows.orderBy(F.col("value").desc(), F.col("name"))
    return rows.limit(limit) if limit is not None else rows


def breakdown_multi(
    w: Warehouse, query: MetricQuery, name: str, series: Mapping[str, str], range_: DateRange
) -> DataFrame:
    """Names with several measures (MQ6)."""
    label = F.coalesce(F.col(_member(name)).cast("string"), F.lit(MISSING_NAME)).alias("name")
    return metric_query(w, query, range_).select(label, *_named(series))


def merge_trends(parts: Sequence[DataFrame]) -> DataFrame:
    """Series of the same grain side by side, with 0 for missing buckets (MQ7)."""
    merged = reduce(lambda left, right: left.join(right, "date", "full_outer"), parts)
    return merged.fillna(0).orderBy("date")


def change(current: Column, previous: Column) -> Column:
    """Change relative to the previous period; null when that was nothing (MQ8)."""
    return F.when(previous != 0, (current - previous) / previous)


def period_change(
    w: Warehouse, query: MetricQuery, range_: DateRange, previous: DateRange
) -> DataFrame:
    """Each measure in both periods and its relative change."""
    names = [_member(m) for m in query.measures]
    both = [
        metric_query(w, query, r).select(F.lit(period).alias("period"), *names)
        for period, r in (("current", range_), ("previous", previous))
    ]
    # Two rows of totals; they are turned into columns by one more grouping.
    sides = both[0].unionByName(both[1]).groupBy().agg(
        *[
            F.max(F.when(F.col("period") == period, F.col(n))).alias(f"{n}_{period}")
            for n in names
            for period in ("current", "previous")
        ]
    )
    return sides.select(
        "*", *[change(F.col(f"{n}_current"), F.col(f"{n}_previous")).alias(f"{n}_change") for n in names]
    )


def _single(df: DataFrame, column: str) -> Column:
    """The one value of a one-row relation, as a column; 0 when it is null."""
    return F.coalesce(df.select(column).scalar(), F.lit(0))


def wall_funnel(w: Warehouse, range_: DateRange) -> DataFrame:
    """Impressions, clicks and same-day subscribers, with their share of the first step (MQ9)."""
    walls = metric_query(
        w, MetricQuery(["paywall.impressions", "paywall.clicks"], time_dimension="paywall.eventDate"), range_
    )
    started = metric_query(
        w, MetricQuery(["paywallFunnel.newSubscribers"], time_dimension="paywallFunnel.eventDate"), range_
    )
    steps = walls.select(
        F.coalesce("impressions", F.lit(0)).alias("base"),
        F.coalesce("clicks", F.lit(0)).alias("clicks"),
        _single(started, "newSubscribers").alias("subscribers"),
    )
    step = F.explode(
        F.array(
            F.struct(F.lit(1).alias("step"), F.lit("impressions").alias("label"), F.col("base").alias("value")),
            F.struct(F.lit(2).alias("step"), F.lit("clicks").alias("label"), F.col("clicks").alias("value")),
            F.struct(
                F.lit(3).alias("step"), F.lit("subscribers").alias("label"), F.col("subscribers").alias("value")
            ),
        )
    )
    rows = steps.select(F.greatest("base", F.lit(1)).alias("base"), step.alias("s"))
    return rows.select("s.step", "s.label", "s.value", (F.col("s.value") / F.col("base")).alias("share"))


def net_new_subscribers(w: Warehouse, range_: DateRange) -> DataFrame:
    """New subscriptions, churns and their difference (MQ10)."""
    new = metric_query(w, MetricQuery(["crm.newSubscribers"], time_dimension="crm.subscriptionDate"), range_)
    gone = metric_query(w, MetricQuery(["crm.newChurns"], time_dimension="crm.churnDate"), range_)
    both = new.select(F.col("newSubscribers"), _single(gone, "newChurns").alias("newChurns"))
    return both.withColumn("netNew", F.col("newSubscribers") - F.col("newChurns"))


def first_wall_share(w: Warehouse, range_: DateRange) -> DataFrame:
    """Share of conversions that happened in the first session with a wall (MQ11)."""
    paths = metric_query(
        w,
        MetricQuery(
            ["subscriptions.newSubscribers"],
            ["subscriptions.convertedOnFirstWallSession"],
            "subscriptions.subscriptionDate",
        ),
        range_,
    )
    first = F.col("convertedOnFirstWallSession")
    counts = paths.agg(
        F.coalesce(F.sum(F.when(first, F.col("newSubscribers"))), F.lit(0)).alias("firstWall"),
        F.coalesce(F.sum(F.when(~first, F.col("newSubscribers"))), F.lit(0)).alias("laterWall"),
    )
    share = F.col("firstWall") / F.greatest(F.col("firstWall") + F.col("laterWall"), F.lit(1))
    return counts.withColumn("share", share)
