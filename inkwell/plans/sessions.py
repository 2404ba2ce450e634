"""Session relations (M1 to M3, M10, M11) and their joint base.

Everything about a session-day comes from one grouping of the hits: its metrics, its
first values and its first campaign. The marts are projections of that relation, so no
session mart has to be joined with another one on the session key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell import fixed_values as fixed
from inkwell.config import EngineConfig
from inkwell.functions import channels
from inkwell.functions.keys import hit_order
from inkwell.functions.params import column_name
from inkwell.operators.firsts import earliest
from inkwell.operators.joins import lookup
from inkwell.operators.ordered import day_bucket, running

# First value of the visit: output column -> column of the hit.
FIRST_VALUES = {
    "session_partition_start_timestamp": "event_timestamp",
    "landing_page_path": "page_path",
    "landing_page_location": "page_location",
    "landing_page_hostname": "page_hostname",
    "referrer": "page_referrer",
    **{f"geo_{name}": f"geo_{name}" for name in fixed.GEO_FIELDS},
    "platform": "platform",
    **{
        f"device_{name}": f"device_{name}"
        for name in (*fixed.DEVICE_TEXT_FIELDS, "is_limited_ad_tracking", "time_zone_offset_seconds")
        if name != "browser_version"
    },
    **{f"device_web_info_{name}": f"device_web_info_{name}" for name in fixed.DEVICE_WEB_FIELDS},
    "user_campaign": "user_campaign",
    "user_medium": "user_medium",
    "user_source": "user_source",
}
SOURCE_FIELDS = (
    "source",
    "medium",
    "source_category",
    "campaign",
    "content",
    "term",
    "default_channel_grouping",
)
SESSION_SOURCE = tuple(f"session_{name}" for name in SOURCE_FIELDS)
LAST_NON_DIRECT = tuple(f"last_non_direct_{name}" for name in SOURCE_FIELDS)
_CAMPAIGN = ("event_source", "event_medium", "event_campaign", "event_content", "event_term")


def conversion_columns(config: EngineConfig) -> list[str]:
    return [f"{column_name(name)}_count" for name in config.conversion_events]


def conversion_counts(config: EngineConfig) -> list:
    """One conditional count per conversion event."""
    return [
        F.count_if(F.col("event_name") == name).alias(column)
        for name, column in zip(config.conversion_events, conversion_columns(config), strict=True)
    ]


def session_days(staged: DataFrame, config: EngineConfig) -> DataFrame:
    """One row per session and day; hits without a client meet per stream and day."""
    browsing = ~F.col("event_name").isin(*fixed.SESSION_OPENERS)
    tagged = browsing & (F.col("event_source") != fixed.DIRECT_SOURCE)
    order = hit_order()
    first_values = F.struct(*[F.col(hit).alias(name) for name, hit in FIRST_VALUES.items()])
    days = staged.groupBy("session_key", "event_date_dt", "client_key", "stream_id").agg(
        F.max("user_id").alias("user_id"),
        F.min("event_timestamp").alias("session_partition_min_timestamp"),
        F.count_if(F.col("event_name") == "page_view").alias("session_partition_count_page_views"),
        F.sum("event_value_in_usd").alias("session_partition_sum_event_value_in_usd"),
        F.coalesce(F.max("session_engaged"), F.lit(0)).alias("session_partition_max_session_engaged"),
        F.sum("engagement_time_msec").alias("session_partition_sum_engagement_time_msec"),
        F.min("session_number").alias("session_number"),
        *conversion_counts(config),
        F.count_if(browsing).alias("browsing_hits"),
        F.min(F.when(browsing, F.col("event_timestamp"))).alias("browsing_timestamp"),
        earliest(first_values, order, browsing).alias("first_values"),
        earliest(F.struct(*_CAMPAIGN), order, tagged).alias("tagged"),
    )
    return days.select(
        "*",
        F.col("event_date_dt").alias("session_partition_date"),
        F.concat("session_key", F.date_format("event_date_dt", "yyyy-MM-dd")).alias("session_partition_key"),
    ).drop("event_date_dt")


def session_traffic_sources(days: DataFrame, categories: DataFrame) -> DataFrame:
    """First non-direct campaign of each session-day (M1).

    The category lookup and the channel rules run on the one campaign that is kept per
    session-day instead of on every hit.
    """
    visits = days.filter(F.col("session_partition_key").isNotNull() & (F.col("browsing_hits") > 0))
    visits = visits.select(
        "client_key",
        "session_partition_key",
        "session_partition_date",
        F.col("browsing_timestamp").alias("session_partition_timestamp"),
        "tagged.*",
    )
    named = categories.withColumnRenamed("source", "event_source")
    visits = lookup(visits, named, "event_source", ["session_partition_key"])
    tagged = F.col("event_source").isNotNull()
    channel = channels.default_channel(
        F.col("event_source"), F.col("event_medium"), F.col("source_category"), F.col("event_campaign")
    )
    return visits.select(
        "client_key",
        "session_partition_key",
        "session_partition_date",
        "session_partition_timestamp",
        channels.or_direct(F.col("event_source")).alias("session_source"),
        channels.or_none(F.col("event_medium")).alias("session_medium"),
        channels.or_none(F.col("source_category")).alias("session_source_category"),
        channels.or_none(F.col("event_campaign")).alias("session_campaign"),
        channels.or_none(F.col("event_content")).alias("session_content"),
        channels.or_none(F.col("event_term")).alias("session_term"),
        F.when(tagged, channel).otherwise("Direct").alias("session_default_channel_grouping"),
        F.when(tagged, F.col("session_partition_key")).alias("non_direct_session_partition_key"),
    )


def last_non_direct(sources: DataFrame, config: EngineConfig) -> DataFrame:
    """Last non-direct campaign within the lookback (M2).

    The newest tagged session-day up to now is the only candidate: if it is older than
    the lookback, so are all others. It travels with its attributes, so no self join.
    """
    stamp = "session_partition_timestamp"
    own = F.struct(stamp, "session_partition_key", *SESSION_SOURCE)
    tagged = F.when(F.col("non_direct_session_partition_key").isNotNull(), own)
    visits = running(sources, ["client_key"], day_bucket(stamp), [stamp], greatest={"candidate": tagged})
    recent = F.col(f"candidate.{stamp}") >= F.col(stamp) - config.lookback_micros
    visits = visits.withColumn("touch", F.coalesce(tagged, F.when(recent, F.col("candidate"))))
    defaults = {"source": channels.or_direct}
    attributes = [
        defaults.get(name, channels.or_none)(F.col(f"touch.session_{name}")).alias(f"last_non_direct_{name}")
        for name in SOURCE_FIELDS[:-1]
    ]
    return visits.select(
        *sources.columns,
        F.col("touch.session_partition_key").alias("session_partition_key_last_non_direct"),
        *attributes,
        F.coalesce("touch.session_default_channel_grouping", F.lit("Direct")).alias(LAST_NON_DIRECT[-1]),
    )


def session_conversions_daily(days: DataFrame, config: EngineConfig) -> DataFrame:
    """Conversion counts per session-day, and per day for hits without a session.

    A row belongs to one day, so a run can replace the days of its window.
    """
    keys = ("session_key", "session_partition_key", "session_partition_date")
    return days.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in conversion_columns(config)])


def session_conversions(days: DataFrame, config: EngineConfig) -> DataFrame:
    """Conversion counts per session-day (M3); hits without a session are one row."""
    return days.groupBy("session_key", "session_partition_key").agg(
        F.min("session_partition_date").alias("session_partition_date"),
        *[F.sum(name).alias(name) for name in conversion_columns(config)],
    )


def session_activity(days: DataFrame, attribution: DataFrame) -> DataFrame:
    """Session-days with metrics, first values and attribution side by side.

    Both inputs have one row per session-day, and the day is part of the join key, so a
    range filter on the day prunes partitions on both sides.
    """
    keyed = attribution.select(
        "session_partition_key", "session_partition_date", *SESSION_SOURCE, *LAST_NON_DIRECT
    )
    visits = days.filter(F.col("browsing_hits") > 0).drop("tagged", "browsing_hits", "browsing_timestamp")
    visits = visits.select("*", "first_values.*").drop("first_values")
    named = visits.filter(F.col("session_partition_key").isNotNull())
    unnamed = visits.filter(F.col("session_partition_key").isNull())
    joined = named.join(keyed, ["session_partition_key", "session_partition_date"], "left")
    return joined.unionByName(unnamed, allowMissingColumns=True)


def session_dimension(activity: DataFrame) -> DataFrame:
    """Descriptive columns of each session-day."""
    return activity.select(
        "stream_id",
        "session_key",
        "session_partition_key",
        "session_partition_date",
        *FIRST_VALUES,
        *SESSION_SOURCE,
        *LAST_NON_DIRECT,
    )


def session_facts(days: DataFrame, config: EngineConfig) -> DataFrame:
    """Metrics of each session-day."""
    return days.filter(F.col("session_key").isNotNull()).select(
        "session_key",
        "client_key",
        "stream_id",
        "user_id",
        "session_partition_key",
        "session_partition_date",
        "session_partition_min_timestamp",
        "session_partition_count_page_views",
        "session_partition_sum_event_value_in_usd",
        "session_partition_max_session_engaged",
        "session_partition_sum_engagement_time_msec",
        "session_number",
        *conversion_columns(config),
    )


def traffic_sources_daily(activity: DataFrame, config: EngineConfig) -> DataFrame:
    """Session-days by campaign and last non-direct campaign."""
    signups = "newsletter_signup_count"
    counted = signups in conversion_columns(config)
    signed_up = F.coalesce(F.sum(signups), F.lit(0)) if counted else F.lit(None).cast("bigint")
    return (
        activity.filter(F.col("session_partition_key").isNotNull())
        .groupBy(
            "session_partition_date",
            "session_default_channel_grouping",
            "session_source",
            "session_medium",
            "last_non_direct_source",
            "last_non_direct_medium",
            "last_non_direct_default_channel_grouping",
        )
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.sum("session_partition_count_page_views").alias("page_views"),
            F.count_if(F.col("session_partition_max_session_engaged") > 0).alias("engaged_sessions"),
            signed_up.alias("newsletter_signups"),
            F.sum("session_partition_sum_engagement_time_msec").alias("engagement_time_msec"),
        )
    )
