"""Last touch of each subscription (M22 and its parts a to g)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell import fixed_values as fixed
from inkwell.functions.keys import hit_order
from inkwell.functions.params import param
from inkwell.functions.readers import micros_to_date, micros_to_timestamp, reader_state
from inkwell.functions.urls import article_number
from inkwell.operators.firsts import earliest, newest
from inkwell.operators.joins import lookup
from inkwell.operators.medians import exact_medians
from inkwell.operators.ordered import DAY_MICROS
from inkwell.rebuilds.states import Bundle, Keep, Tables

_PLACE = (
    "platform",
    "device_category",
    "device_operating_system",
    "device_browser",
    "geo_country",
    "geo_region",
    "geo_city",
)
_SOURCE = ("session_source", "session_medium", "session_campaign", "session_default_channel_grouping")


def subscribers(accounts: DataFrame) -> DataFrame:
    """Accounts that ever subscribed."""
    return accounts.filter(F.col("subscription_date").isNotNull()).select(
        "user_id", "user_pseudo_id", "subscription_date", "subscription_tier", "churn_date"
    )


def subscribe_days(staged: DataFrame) -> DataFrame:
    """Earliest subscribe hit of each login and day, with its place in the order of hits."""
    hit = F.struct(
        hit_order().alias("at"),
        "session_partition_key",
        "event_timestamp",
        param(F.col("event_params"), "article_id").try_cast("int").alias("article_id"),
    )
    bought = staged.filter((F.col("event_name") == "subscribe") & F.col("user_id").isNotNull())
    return bought.groupBy("user_id", "event_date_dt").agg(earliest(hit, hit_order()).alias("hit"))


def subscribe_hits() -> Bundle:
    """Earliest subscribe hit of each login, a state that days are added to."""

    def advance(state: Tables | None, days: Tables, keep: Keep) -> Tables:
        rows = days["subscribe_days"].drop("event_date_dt")
        if state:
            rows = rows.unionByName(state["subscribe_hits"])
        return {"subscribe_hits": rows.groupBy("user_id").agg(earliest(F.col("hit"), F.col("hit.at")).alias("hit"))}

    return Bundle(("subscribe_hits",), ("subscribe_days",), advance)


def buyers(accounts: DataFrame, hits: DataFrame) -> DataFrame:
    """Subscribers with their subscribe hit, where there is one."""
    earliest_hits = hits.select(
        "user_id",
        F.col("hit.session_partition_key").alias("subscribe_session_key"),
        F.col("hit.event_timestamp").alias("subscription_ts"),
        F.col("hit.article_id").alias("paywall_article_id"),
    )
    return subscribers(accounts).join(earliest_hits, "user_id", "left")


def touch_hits(staged: DataFrame) -> DataFrame:
    """The three kinds of hits that a journey is made of, reduced to the columns in use."""
    article = F.coalesce(param(F.col("event_params"), "article_id"), article_number(F.col("page_location")))
    kinds = ("session_start", "page_view", "paywall_impression")
    return staged.filter(F.col("event_name").isin(*kinds) & F.col("user_pseudo_id").isNotNull()).select(
        "user_pseudo_id",
        "event_name",
        "event_date_dt",
        "event_timestamp",
        F.col("user_id").alias("login"),
        "session_partition_key",
        *_PLACE,
        article.try_cast("int").alias("article_id"),
    )


_PEOPLE = ("user_id", "user_pseudo_id", "subscription_date", "subscribe_session_key", "subscription_ts")


def journey_people(buying: DataFrame, version: str = "") -> DataFrame:
    """What a journey depends on, and the run in which it was looked up."""
    return buying.select(*_PEOPLE, F.lit(version).alias("version"))


def journey_hits(touches: DataFrame, people: DataFrame) -> DataFrame:
    """Hits of each subscriber's client up to the day of the subscription.

    Clients that never subscribed drop out in this join.
    """
    return touches.join(people, "user_pseudo_id").filter(F.col("event_date_dt") <= F.col("subscription_date"))


def journeys(hits: DataFrame, people: DataFrame) -> DataFrame:
    """The journeys that are in force: those of the version in which a subscriber was last looked up."""
    return hits.join(people.select("user_id", "version"), ["user_id", "version"], "left_semi").drop("version")


def changed_people(buying: DataFrame, known: DataFrame, version: str) -> DataFrame:
    """:func:`journey_people` of now: subscribers as they were keep their version, others get a new one."""
    before = known.select(*[F.col(c).alias(f"_{c}") for c in (*_PEOPLE, "version")])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _PEOPLE]
    return buying.select(*_PEOPLE).join(before, same, "left").select(
        *_PEOPLE, F.coalesce("_version", F.lit(version)).alias("version")
    )


def touch_points(journey: DataFrame) -> DataFrame:
    """Purchase session, last read and first wall of each subscriber, in one grouping.

    With a subscribe hit the purchase session is the one of that hit and the last read
    lies in the week before it; without one, both are looked up by the day of the
    subscription. The two ways exclude each other per subscriber.
    """
    name, at = F.col("event_name"), F.col("event_timestamp")
    bought = F.col("subscription_ts").isNotNull()
    session = F.col("session_partition_key")
    visit = (name == "session_start") & (~bought | (session == F.col("subscribe_session_key")))
    week = fixed.READ_WINDOW_DAYS
    before_hit = (at < F.col("subscription_ts")) & (at >= F.col("subscription_ts") - week * DAY_MICROS)
    before_day = F.col("event_date_dt") >= F.date_sub("subscription_date", week)
    read = (
        (name == "page_view")
        & F.col("article_id").isNotNull()
        & F.when(bought, before_hit).otherwise(before_day)
    )
    place = F.struct("session_partition_key", "event_date_dt", "event_timestamp", *_PLACE)
    reading = F.struct("article_id", "event_timestamp", reader_state(F.col("login")).alias("reader_state"))
    wall = F.struct("session_partition_key", "event_timestamp")
    moment = F.struct("event_timestamp", "session_partition_key")
    return journey.groupBy("user_id").agg(
        newest(place, moment, visit).alias("purchase"),
        newest(reading, F.struct("event_timestamp", "session_partition_key", "article_id"), read).alias("read"),
        earliest(wall, moment, name == "paywall_impression").alias("wall"),
    )


def purchase_sessions(touches: DataFrame) -> DataFrame:
    """Purchase session of each subscriber that has one."""
    return touches.filter(F.col("purchase").isNotNull()).select(
        "user_id",
        F.col("purchase.session_partition_key").alias("purchase_session_key"),
        F.col("purchase.event_date_dt").alias("purchase_session_date"),
        F.col("purchase.event_timestamp").alias("purchase_session_ts"),
        *[F.col(f"purchase.{name}").alias(name) for name in _PLACE],
    )


def last_reads(touches: DataFrame) -> DataFrame:
    """Last article read before the subscription."""
    return touches.filter(F.col("read").isNotNull()).select(
        "user_id",
        F.col("read.article_id").alias("last_article_id"),
        F.col("read.event_timestamp").alias("last_read_ts"),
        F.col("read.reader_state").alias("last_article_reader_state"),
    )


def first_walls(touches: DataFrame) -> DataFrame:
    """First session that met a wall (M22e)."""
    return touches.filter(F.col("wall").isNotNull()).select(
        "user_id",
        F.col("wall.session_partition_key").alias("first_wall_session_key"),
        F.col("wall.event_timestamp").alias("first_wall_ts"),
    )


def prior_walls(journey: DataFrame, purchases: DataFrame) -> DataFrame:
    """Wall impressions before the purchase session, of subscribers with both (M22d)."""
    walls = journey.filter(F.col("event_name") == "paywall_impression").select("user_id", "event_timestamp")
    start = purchases.select("user_id", "purchase_session_ts")
    return (
        walls.join(start, "user_id")
        .groupBy("user_id")
        .agg(
            F.count_if(F.col("event_timestamp") < F.col("purchase_session_ts")).alias("prior_wall_impressions")
        )
    )


def subscription_rows(
    buying: DataFrame, journey: DataFrame, sources: DataFrame, articles: DataFrame
) -> DataFrame:
    """One row per subscription, without the medians over all of them (M22g).

    ``buying`` and ``journey`` are written tables: they hold the few hits that matter, so that the
    groupings and joins here do not go back to all hits.
    """
    touches = touch_points(journey)
    purchases = purchase_sessions(touches)
    # Inner first: the few purchase sessions select their rows of the large relation.
    campaigns = (
        purchases.select("user_id", F.col("purchase_session_key").alias("session_partition_key"))
        .join(sources.select("session_partition_key", *_SOURCE), "session_partition_key")
        .select("user_id", *_SOURCE)
    )
    read_article = articles.select(
        F.col("article_id").alias("last_article_id"),
        F.col("title").alias("last_article_title"),
        F.col("section").alias("last_article_section"),
    )
    wall_article = articles.select(
        F.col("article_id").alias("paywall_article_id"), F.col("title").alias("paywall_article_title")
    )
    rows = (
        buying.join(purchases, "user_id", "left")
        .join(last_reads(touches), "user_id", "left")
        .join(first_walls(touches), "user_id", "left")
        .join(prior_walls(journey, purchases), "user_id", "left")
        .join(campaigns, "user_id", "left")
    )
    rows = lookup(rows, read_article, "last_article_id", ["user_id"])
    rows = lookup(rows, wall_article, "paywall_article_id", ["user_id"])
    subscribed = F.col("subscription_date")

    def days_since(micros: str):
        return F.datediff(subscribed, micros_to_date(F.col(micros)))

    return rows.select(
        "user_id",
        "subscription_tier",
        "subscription_date",
        "churn_date",
        F.when(F.col("subscription_ts").isNotNull(), "subscribe_event")
        .otherwise("crm_only")
        .alias("subscription_source"),
        micros_to_timestamp(F.col("subscription_ts")).alias("subscription_timestamp"),
        "paywall_article_id",
        "paywall_article_title",
        "purchase_session_key",
        "purchase_session_date",
        micros_to_timestamp(F.col("purchase_session_ts")).alias("purchase_session_start"),
        (F.col("purchase_session_date") == subscribed).alias("purchased_same_day"),
        "first_wall_session_key",
        "prior_wall_impressions",
        days_since("first_wall_ts").alias("days_first_wall_to_sub"),
        *_PLACE,
        *_SOURCE,
        "last_article_id",
        "last_article_title",
        "last_article_section",
        micros_to_timestamp(F.col("last_read_ts")).alias("last_article_read_at"),
        "last_article_reader_state",
        days_since("last_read_ts").alias("days_last_read_before_subscription"),
        (F.col("purchase_session_key") == F.col("first_wall_session_key")).alias(
            "converted_on_first_wall_session"
        ),
    )


def journey_medians(rows: DataFrame) -> DataFrame:
    """One row: exact medians of the journeys (M22f), found by counting; no values are gathered."""
    medians = exact_medians(rows, ["prior_wall_impressions", "days_first_wall_to_sub"])
    return medians.select(
        F.col("prior_wall_impressions").alias("median_prior_wall_impressions"),
        F.col("days_first_wall_to_sub").alias("median_days_first_wall_to_sub"),
    )


def subscription_last_touch(rows: DataFrame) -> DataFrame:
    """Subscriptions with the medians on every row."""
    medians = journey_medians(rows).select(F.struct("*")).scalar()
    names = ("median_prior_wall_impressions", "median_days_first_wall_to_sub")
    return rows.withColumn("_medians", medians).select(
        *rows.columns, *[F.col("_medians")[name].alias(name) for name in names]
    )
