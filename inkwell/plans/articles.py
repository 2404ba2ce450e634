"""Article, paywall and wall-policy relations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell import fixed_values as fixed
from inkwell.functions.params import param
from inkwell.functions.readers import (
    active_subscription,
    event_article,
    mentions_article,
    reader_tier,
    reader_type,
)
from inkwell.operators.joins import heavy_keys, lookup
from inkwell.operators.ordered import day_bucket, running

_COUNTED = {
    "page_view": "page_views",
    "scroll": "scroll_events",
    "share": "share_events",
    "bookmark": "bookmark_events",
    "comment": "comment_events",
    "video_start": "video_starts",
    "video_complete": "video_completes",
    "newsletter_signup": "newsletter_signups",
}
_METRICS = (
    "page_views",
    "distinct_client_keys",
    "new_client_keys",
    "entrances",
    "scroll_events",
    "avg_scroll_percent",
    "share_events",
    "bookmark_events",
    "comment_events",
    "video_starts",
    "video_completes",
    "engagement_time_msec",
    "newsletter_signups",
)
_CMS = ("title", "section", "author", "published_at", "word_count", "is_breaking", "has_video")


def article_hits(staged: DataFrame) -> DataFrame:
    """Hits about an article, with the article's number (P20)."""
    pairs = F.col("event_params")
    article, item = param(pairs, "article_id"), param(pairs, "item_id")
    name, location = F.col("event_name"), F.col("page_location")
    return (
        staged.filter(name.isin(*fixed.ARTICLE_EVENTS) & mentions_article(article, item, location))
        .select(
            "event_date_dt",
            event_article(name, article, item, location).alias("article_id"),
            "event_name",
            "client_key",
            "user_id",
            "session_number",
            "engagement_time_msec",
            param(pairs, "entrances", "int").alias("entrances"),
            param(pairs, "percent_scrolled", "int").alias("percent_scrolled"),
        )
        .filter(F.col("article_id").isNotNull())
    )


def _reduced(hits: DataFrame, *keys: str) -> DataFrame:
    """Article metrics per client: small enough to join and regroup."""
    name = F.col("event_name")

    def on(event: str, value):
        return F.when(name == event, value)

    return hits.groupBy(*keys, "client_key").agg(
        *[F.count_if(name == event).alias(column) for event, column in _COUNTED.items()],
        F.sum(on("page_view", (F.col("session_number") == 1).cast("bigint"))).alias("new_client_keys"),
        F.sum(on("page_view", F.col("entrances"))).alias("entrances"),
        F.sum(on("scroll", F.col("percent_scrolled"))).alias("scrolled"),
        F.count(on("scroll", F.col("percent_scrolled"))).alias("scrolls"),
        F.sum(on("user_engagement", F.col("engagement_time_msec"))).alias("engagement_time_msec"),
    )


def _totals(reduced: DataFrame, *keys: str) -> DataFrame:
    """Metrics from rows that are one per client: readers are then rows, not distinct values."""
    summed = [*_COUNTED.values(), "new_client_keys", "entrances", "engagement_time_msec"]
    return reduced.groupBy(*keys).agg(
        *[F.coalesce(F.sum(column), F.lit(0)).alias(column) for column in summed],
        F.count_if((F.col("page_views") > 0) & F.col("client_key").isNotNull()).alias("distinct_client_keys"),
        (F.sum("scrolled") / F.nullif(F.sum("scrolls"), F.lit(0))).alias("avg_scroll_percent"),
    )


def _per_client(reduced: DataFrame, *keys: str) -> DataFrame:
    """The logins of a client put together."""
    summed = [*_COUNTED.values(), "new_client_keys", "entrances", "scrolled", "scrolls", "engagement_time_msec"]
    return reduced.groupBy(*keys, "client_key").agg(*[F.sum(column).alias(column) for column in summed])


def articles_daily(staged: DataFrame, articles: DataFrame) -> DataFrame:
    """Daily metrics of each known article."""
    keys = ("event_date_dt", "article_id")
    daily = _totals(_reduced(article_hits(staged), *keys), *keys)
    return daily.join(articles, "article_id").select(*keys, *_CMS, *_METRICS)


def articles_by_reader_type(staged: DataFrame, articles: DataFrame, accounts: DataFrame) -> DataFrame:
    """Daily metrics of each known article by reader type and tier.

    Hits are reduced per article, login and client before they meet the accounts.
    """
    keys = ("event_date_dt", "article_id", "reader_type", "subscription_tier")
    reduced = _reduced(article_hits(staged), "event_date_dt", "article_id", "user_id")
    people = accounts.select(
        "user_id",
        F.lit(True).alias("known"),
        "subscription_date",
        "churn_date",
        F.col("subscription_tier").alias("tier"),
    )
    read = lookup(reduced, people, "user_id", ["client_key", "event_date_dt", "article_id"])
    day, known = F.col("event_date_dt"), F.col("known")
    subscribed, churned = F.col("subscription_date"), F.col("churn_date")
    read = read.withColumns(
        {
            "reader_type": reader_type(day, known, subscribed, churned),
            "subscription_tier": reader_tier(day, known, subscribed, churned, F.col("tier")),
        }
    )
    daily = _totals(_per_client(read, *keys), *keys)
    return daily.join(articles, "article_id").select(*keys, *_CMS, *_METRICS)


def paywall_daily(staged: DataFrame) -> DataFrame:
    """Wall impressions and clicks by article, wall and offer."""
    pairs, name = F.col("event_params"), F.col("event_name")
    return (
        staged.filter(name.isin(*fixed.WALL_EVENTS))
        .select(
            "event_date_dt",
            param(pairs, "article_id").try_cast("int").alias("article_id"),
            param(pairs, "paywall_type").alias("paywall_type"),
            param(pairs, "bundle_offer").alias("bundle_offer"),
            "event_name",
        )
        .filter(F.col("article_id").isNotNull())
        .groupBy("event_date_dt", "article_id", "paywall_type", "bundle_offer")
        .agg(
            F.count_if(name == "paywall_impression").alias("paywall_impressions"),
            F.count_if(name == "paywall_click").alias("paywall_clicks"),
        )
    )


def paywall_sessions_daily(staged: DataFrame) -> DataFrame:
    """Session-days that met a wall (M20); hits without a session are left out."""
    name = F.col("event_name")
    return (
        staged.filter(name.isin(*fixed.WALL_EVENTS) & F.col("session_partition_key").isNotNull())
        .groupBy("event_date_dt", "session_partition_key")
        .agg(
            F.count_if(name == "paywall_impression").alias("paywall_impressions"),
            F.count_if(name == "paywall_click").alias("paywall_clicks"),
        )
        .filter(F.col("paywall_impressions") > 0)
    )


def wall_policy(
    page_views: DataFrame,
    articles: DataFrame,
    accounts: DataFrame,
    walls: Mapping[str, str],
    free_reads: int = fixed.FREE_READS_PER_MONTH,
) -> DataFrame:
    """Wall each article read would meet (M23): ``free``, ``metered`` or ``hard``.

    ``walls`` gives the wall of each section. Reads are counted per client and calendar
    month; subscribers meet no wall. The count runs by day and carries over from day to
    day, so a client with very many reads is not one task.
    """
    day = F.col("event_date_dt")
    reads = page_views.select(
        "event_key",
        "client_key",
        "event_date_dt",
        "event_timestamp",
        "batch_page_id",
        "batch_ordering_id",
        "batch_event_index",
        "user_id",
        F.col("article_id").try_cast("int").alias("article_id"),
    ).filter(F.col("article_id").isNotNull() & F.col("client_key").isNotNull())
    numbered = reads.withColumn("month", F.trunc(day, "month"))
    reads = running(
        numbered,
        ["client_key", "month"],
        day_bucket("event_timestamp"),
        ["event_timestamp", "batch_page_id", "batch_ordering_id", "batch_event_index", "event_key"],
        total={"read_of_month": F.lit(1).cast("bigint")},
    )
    sections = articles.select("article_id", "section")
    people = accounts.select("user_id", "subscription_date", "churn_date")
    # Raw reads: an article or a login may hold a large share of them.
    known = lookup(reads, sections, "article_id", ["event_key"], heavy_keys(numbered, "article_id"))
    known = lookup(known, people, "user_id", ["event_key"], heavy_keys(numbered, "user_id"))
    section = F.col("section")
    hard = [name for name, wall in walls.items() if wall == "hard"]
    metered = [name for name, wall in walls.items() if wall == "metered"]
    wall = (
        F.when(active_subscription(day, F.col("subscription_date"), F.col("churn_date")), "free")
        .when(section.isin(*hard), "hard")
        .when(section.isin(*metered) & (F.col("read_of_month") > free_reads), "metered")
        .otherwise("free")
    )
    return known.select(
        "event_key", "client_key", "event_date_dt", "event_timestamp", "article_id", "section",
        "read_of_month", wall.alias("wall"),
    )
