"""The 14 cubes: a base relation, measures and dimensions each (MQ12 to MQ15)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.readers import active_subscription
from inkwell.operators.joins import lookup
from inkwell.operators.spine import as_of_counts, day_range
from inkwell.plans.actives import CLIENTS, LOGINS, VISITORS
from inkwell.plans.warehouse import Warehouse

Measure = Callable[[], Column]


@dataclass(frozen=True)
class Cube:
    """Measures are aggregates over ``relation``; dimensions name its columns."""

    relation: Callable[[Warehouse], DataFrame]
    measures: Mapping[str, Measure]
    dimensions: Mapping[str, str]
    # Measures that are distinct ids, and whose they are in the day's bitmaps.
    actives: Mapping[str, str] = field(default_factory=dict)


def _sum(column: str) -> Measure:
    return lambda: F.sum(column)


def _avg(column: str) -> Measure:
    return lambda: F.avg(column)


def _max(column: str) -> Measure:
    return lambda: F.max(column)


def _min(column: str) -> Measure:
    return lambda: F.min(column)


def _rows() -> Column:
    return F.count(F.lit(1))


def _filled(column: str) -> Measure:
    return lambda: F.count(column)


def _distinct(column: str) -> Measure:
    return lambda: F.countDistinct(column)


def _seconds(column: str) -> Measure:
    """Milliseconds are summed as whole numbers, so the sum does not depend on order."""
    return lambda: F.sum(column) / F.lit(1000.0)


def _ratio(over: Measure, under: Measure) -> Measure:
    return lambda: over().cast("double") / F.nullif(under().cast("double"), F.lit(0.0))


def _events(w: Warehouse) -> DataFrame:
    """Hits, counted per day, name, client, login and page, with the subscription dates of their
    login (MQ12). The accounts meet the counts, not the hits."""
    hits = w.table("events_daily")
    people = w.table("accounts").select(
        "user_id",
        F.col("subscription_date").alias("crm_subscription_date"),
        F.col("churn_date").alias("crm_churn_date"),
        F.lit(True).alias("registered"),
    )
    return lookup(hits, people, "user_id", ["client_key", "page_location"])


def _active_subscribers() -> Column:
    active = active_subscription(
        F.col("event_date"), F.col("crm_subscription_date"), F.col("crm_churn_date")
    )
    return F.countDistinct(F.when(active, F.col("user_id")))


def _visits(w: Warehouse) -> DataFrame:
    """Session-days with a session; dimension and fact columns are already side by side."""
    engaged = F.when(F.col("session_partition_max_session_engaged") > 0, 1).otherwise(0)
    return (
        w.table("session_activity")
        .filter(F.col("session_partition_key").isNotNull())
        .withColumns(
            {
                "session_engaged_flag": engaged,
                "page_view_count": F.col("session_partition_count_page_views"),
                "engagement_time_msec": F.col("session_partition_sum_engagement_time_msec"),
            }
        )
    )


def _event_date(relation: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w.table(relation).withColumn("event_date", F.col("event_date_dt"))


def _paywall_funnel(w: Warehouse) -> DataFrame:
    """Exposed sessions per day, with the subscriptions of that day (MQ13).

    Subscriptions are counted per day before the join, which keeps the days of the
    exposed sessions only.
    """
    exposed = (
        w.table("paywall_sessions_daily")
        .groupBy(F.col("event_date_dt").alias("event_date"))
        .agg(
            F.count(F.lit(1)).alias("sessions_exposed"),
            F.sum("paywall_impressions").alias("impressions"),
            F.sum("paywall_clicks").alias("clicks"),
        )
    )
    started = (
        w.table("subscription_rows")
        .groupBy(F.col("subscription_date").alias("event_date"))
        .agg(F.count(F.lit(1)).alias("new_subscribers"))
    )
    return exposed.join(started, "event_date", "left").fillna(0, ["new_subscribers"])


def _crm_totals(w: Warehouse) -> DataFrame:
    """Accounts registered, subscribed and churned as of each day (MQ14)."""
    totals = as_of_counts(
        day_range(w.table("events_daily"), "event_date"),
        w.table("accounts"),
        {
            "registered_total": F.col("registration_date"),
            "subscriber_starts_total": F.col("subscription_date"),
            "churned_total": F.col("churn_date"),
        },
    )
    active = F.col("subscriber_starts_total") - F.col("churned_total")
    return totals.withColumn("active_subscribers_total", active)


def _content_totals(w: Warehouse) -> DataFrame:
    """Articles published as of the start of each day (MQ15): an article that comes out
    during a day counts from the next day on."""
    published = F.col("published_at")
    day = published.cast("date")
    counted_from = F.when(published > day.cast("timestamp"), F.date_add(day, 1)).otherwise(day)
    return as_of_counts(
        day_range(w.table("events_daily"), "event_date"), w.table("articles"), {"articles_total": counted_from}
    )


_CHANNEL_DIMENSIONS = {
    "channelGrouping": "session_default_channel_grouping",
    "trafficSource": "session_source",
    "sourceMedium": "session_medium",
    "utmCampaign": "session_campaign",
    "utmContent": "session_content",
    "lastNonDirectSource": "last_non_direct_source",
    "lastNonDirectMedium": "last_non_direct_medium",
    "lastNonDirectChannelGrouping": "last_non_direct_default_channel_grouping",
}
_ARTICLE_DIMENSIONS = {
    "articleId": "article_id",
    "title": "title",
    "section": "section",
    "author": "author",
    "wordCount": "word_count",
    "publicationDate": "published_at",
    "isBreaking": "is_breaking",
    "hasVideo": "has_video",
}
_session_count, _client_count = _distinct("session_key"), _distinct("client_key")
_engaged_seconds = _seconds("engagement_time_msec")

CUBES: dict[str, Cube] = {
    "articles": Cube(
        _event_date("articles_daily"),
        {
            "articlePageviews": _sum("page_views"),
            "readers": _sum("distinct_client_keys"),
            "newReaders": _sum("new_client_keys"),
            "entrances": _sum("entrances"),
            "scrollEvents": _sum("scroll_events"),
            "avgScrollPercent": _avg("avg_scroll_percent"),
            "shares": _sum("share_events"),
            "bookmarks": _sum("bookmark_events"),
            "comments": _sum("comment_events"),
            "videoStarts": _sum("video_starts"),
            "videoCompletes": _sum("video_completes"),
            "engagedTime": _engaged_seconds,
            "newsletterSignups": _sum("newsletter_signups"),
        },
        {**_ARTICLE_DIMENSIONS, "eventDate": "event_date"},
    ),
    "content": Cube(
        lambda w: w.table("articles"), {"articlesPublished": _rows}, dict(_ARTICLE_DIMENSIONS)
    ),
    "contentTotals": Cube(
        _content_totals, {"numberOfArticles": _max("articles_total")}, {"asOfDate": "as_of_date"}
    ),
    "crm": Cube(
        lambda w: w.table("accounts"),
        {
            "newRegisteredUsers": _rows,
            "newSubscribers": _filled("subscription_date"),
            "newChurns": _filled("churn_date"),
        },
        {
            "country": "country",
            "tier": "subscription_tier",
            "registrationDate": "registration_date",
            "subscriptionDate": "subscription_date",
            "churnDate": "churn_date",
        },
    ),
    "crmTotals": Cube(
        _crm_totals,
        {
            "numberOfRegisteredUsers": _max("registered_total"),
            "cumulativeSubscribers": _max("subscriber_starts_total"),
            "cumulativeChurns": _max("churned_total"),
            # Churn lets this total fall, so the period's value is its last one.
            "numberOfSubscribers": lambda: F.max_by("active_subscribers_total", "as_of_date"),
        },
        {"asOfDate": "as_of_date"},
    ),
    "events": Cube(
        _events,
        {
            "eventsCount": lambda: F.coalesce(F.sum("hits"), F.lit(0)),
            "activeUsers": _client_count,
            "activeRegisteredUsers": _distinct("user_id"),
            # Stricter form of the catalog: logins that have an account.
            "activeAccounts": lambda: F.countDistinct(F.when(F.col("registered"), F.col("user_id"))),
            "activeSubscribers": _active_subscribers,
        },
        {"eventName": "event_name", "eventDate": "event_date", "url": "page_location"},
        {"activeUsers": CLIENTS, "activeRegisteredUsers": LOGINS},
    ),
    "pages": Cube(
        _event_date("pages"),
        {
            "pageviews": _sum("page_views"),
            "entrances": _sum("entrances"),
            "engagedTime": _seconds("total_engagement_time_msec"),
            "scrollEvents": _sum("scroll_events"),
        },
        {"url": "page_location", "eventDate": "event_date"},
    ),
    "paywall": Cube(
        _event_date("paywall_daily"),
        {
            "impressions": _sum("paywall_impressions"),
            "clicks": _sum("paywall_clicks"),
            "ctr": _ratio(_sum("paywall_clicks"), _sum("paywall_impressions")),
        },
        {
            "paywallType": "paywall_type",
            "bundleOffer": "bundle_offer",
            "articleId": "article_id",
            "eventDate": "event_date",
        },
    ),
    "paywallFunnel": Cube(
        _paywall_funnel,
        {
            "sessionsExposed": _sum("sessions_exposed"),
            "impressions": _sum("impressions"),
            "clicks": _sum("clicks"),
            "newSubscribers": _sum("new_subscribers"),
            "paywallConversionRate": _ratio(_sum("new_subscribers"), _sum("sessions_exposed")),
            "ctr": _ratio(_sum("clicks"), _sum("impressions")),
        },
        {"eventDate": "event_date"},
    ),
    "paywallSessions": Cube(
        _event_date("paywall_sessions_daily"),
        {
            "sessionsWithPaywallImpression": _rows,
            "impressions": _sum("paywall_impressions"),
            "clicks": _sum("paywall_clicks"),
        },
        {"eventDate": "event_date"},
    ),
    "readerTypes": Cube(
        _event_date("articles_by_reader_type"),
        {"articlePageviews": _sum("page_views"), "engagedTime": _engaged_seconds},
        {
            "readerType": "reader_type",
            "subscriptionTier": "subscription_tier",
            "articleId": "article_id",
            "title": "title",
            "section": "section",
            "eventDate": "event_date",
        },
    ),
    "sessions": Cube(
        _visits,
        {
            "sessions": _session_count,
            "activeUsers": _client_count,
            "engagedSessions": _sum("session_engaged_flag"),
            "pageviews": _sum("page_view_count"),
            "engagedTime": _engaged_seconds,
            "avgEngagedTimePerUser": _ratio(_engaged_seconds, _client_count),
            "avgEngagedTimePerSession": _ratio(_engaged_seconds, _session_count),
            "pageviewsPerUser": _ratio(_sum("page_view_count"), _client_count),
            "pageviewsPerSession": _ratio(_sum("page_view_count"), _session_count),
            "sessionsPerUser": _ratio(_session_count, _client_count),
        },
        {
            "eventDate": "session_partition_date",
            "country": "geo_country",
            "platform": "platform",
            "device": "device_category",
            "deviceOs": "device_operating_system",
            **_CHANNEL_DIMENSIONS,
            "landingPage": "landing_page_path",
        },
        {"activeUsers": VISITORS},
    ),
    "subscriptions": Cube(
        lambda w: w.relation("subscription_last_touch"),
        {
            "newSubscribers": _rows,
            "conversionsLaterChurned": _filled("churn_date"),
            "avgPriorWallImpressions": _avg("prior_wall_impressions"),
            "medianPriorWallImpressions": _min("median_prior_wall_impressions"),
            "medianDaysFirstWallToSub": _min("median_days_first_wall_to_sub"),
        },
        {
            "tier": "subscription_tier",
            "subscriptionSource": "subscription_source",
            "subscriptionDate": "subscription_date",
            "churnDate": "churn_date",
            "platform": "platform",
            "deviceCategory": "device_category",
            "deviceOs": "device_operating_system",
            "browser": "device_browser",
            "country": "geo_country",
            "region": "geo_region",
            "trafficSource": "session_source",
            "sourceMedium": "session_medium",
            "utmCampaign": "session_campaign",
            "channelGrouping": "session_default_channel_grouping",
            "paywallArticleId": "paywall_article_id",
            "purchasedSameDay": "purchased_same_day",
            "convertedOnFirstWallSession": "converted_on_first_wall_session",
            "priorWallImpressions": "prior_wall_impressions",
            "lastArticleSection": "last_article_section",
        },
    ),
    "traffic": Cube(
        _visits,
        {
            "sessions": _session_count,
            "pageviews": _sum("page_view_count"),
            "engagedSessions": _sum("session_engaged_flag"),
            "engagedTime": _engaged_seconds,
            "newsletterSignups": _sum("newsletter_signup_count"),
            "activeUsers": _client_count,
            "avgEngagedTimePerSession": _ratio(_engaged_seconds, _session_count),
        },
        {"eventDate": "session_partition_date", **_CHANNEL_DIMENSIONS},
    ),
}
