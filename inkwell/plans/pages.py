"""Page relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.config import EngineConfig
from inkwell.functions.keys import page_engagement_key
from inkwell.operators.joins import lookup
from inkwell.plans.sessions import conversion_columns, conversion_counts


def page_conversions(staged: DataFrame, config: EngineConfig) -> DataFrame:
    """Conversion counts per page and day (M4)."""
    return staged.groupBy("page_key").agg(*conversion_counts(config))


def page_engaged_time(staged: DataFrame) -> DataFrame:
    """Average engaged time per session and page (M5).

    A page view reports the time spent on the page before it, every other hit the time
    on its own page. A page view therefore feeds two keys: its own page with one view,
    and its referrer with the time. Both sides meet in one grouping, without a join.
    """
    viewed = F.col("event_name") == "page_view"
    here = page_engagement_key()
    none = F.lit(None).cast("bigint")
    time = F.col("engagement_time_msec")
    own = F.struct(
        here.alias("page_engagement_key"),
        viewed.cast("bigint").alias("views"),
        F.when(~viewed, time).alias("time"),
    )
    before = F.struct(
        page_engagement_key("page_referrer").alias("page_engagement_key"),
        F.lit(0).cast("bigint").alias("views"),
        F.when(viewed, time).otherwise(none).alias("time"),
    )
    # Hits that neither view a page nor report time change no result.
    marks = F.when(viewed & time.isNotNull(), F.array(own, before)).otherwise(F.array(own))
    useful = staged.filter(viewed | time.isNotNull())
    parts = useful.select(F.explode(marks).alias("mark")).select("mark.*")
    per_page = parts.groupBy("page_engagement_key").agg(F.sum("views").alias("views"), F.sum("time").alias("time"))
    keyed = F.col("page_engagement_key").isNotNull()
    counted = F.when(keyed, F.col("views")).otherwise(0)
    timed = keyed & F.col("time").isNotNull()
    return per_page.filter(F.col("views") > 0).select(
        "page_engagement_key",
        F.when(timed, F.col("time") / F.col("views")).alias("page_engagement_time_msec"),
        F.when(timed, counted).alias("page_engagement_denominator"),
    )


def pages(page_views: DataFrame, staged: DataFrame, engaged_time: DataFrame, config: EngineConfig) -> DataFrame:
    """Daily metrics of each page."""
    page = ["event_date_dt", "stream_id", "page_location", "page_key"]
    views = page_views.groupBy(*page, "page_engagement_key").agg(
        F.count("event_name").alias("page_views"),
        F.countDistinct("client_key").alias("distinct_client_keys"),
        F.count_if(F.col("session_number") == 1).alias("new_client_keys"),
        F.sum(F.coalesce("entrances", F.lit(0))).alias("entrances"),
    )
    timed = lookup(views, engaged_time, "page_engagement_key", page)
    totals = ["page_views", "distinct_client_keys", "new_client_keys", "entrances"]
    per_page = timed.groupBy(*page).agg(
        *[F.sum(name).alias(name) for name in totals],
        F.sum("page_engagement_time_msec").alias("total_engagement_time_msec"),
        F.sum("page_engagement_denominator").alias("avg_engagement_time_denominator"),
    )
    counts = [*conversion_columns(config), "scroll_events"]
    actions = (
        staged.filter(F.col("event_name").isin(*config.conversion_events, "scroll"))
        .groupBy("event_date_dt", "page_location")
        .agg(*conversion_counts(config), F.count_if(F.col("event_name") == "scroll").alias("scroll_events"))
    )
    return per_page.join(actions, ["event_date_dt", "page_location"], "left").select(
        *page,
        *totals,
        "total_engagement_time_msec",
        "avg_engagement_time_denominator",
        *[F.coalesce(name, F.lit(0)).alias(name) for name in counts],
    )
