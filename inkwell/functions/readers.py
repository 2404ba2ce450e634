"""Articles, readers and moments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell import fixed_values as fixed
from inkwell.functions.urls import article_number


def normalise_event_name(name: Column) -> Column:
    return F.lower(F.replace(F.trim(name), F.lit(" "), F.lit("_")))


def export_date(text: Column) -> Column:
    return F.to_date(text, "yyyyMMdd")


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def event_article(name: Column, article_param: Column, item_param: Column, location: Column) -> Column:
    """Article a hit is about: a parameter for most events, the URL for the others."""
    text = (
        F.when(name == "share", item_param)
        .when(name.isin(*fixed.ARTICLE_ID_EVENTS), article_param)
        .otherwise(article_number(location))
    )
    return text.try_cast("int")


def mentions_article(article_param: Column, item_param: Column, location: Column) -> Column:
    return article_param.isNotNull() | item_param.isNotNull() | location.contains("article-")


def active_subscription(day: Column, subscribed: Column, churned: Column) -> Column:
    """Whether a subscription runs on ``day``; it ends on its churn date."""
    return F.coalesce((subscribed <= day) & (churned.isNull() | (churned > day)), F.lit(False))


def reader_type(day: Column, account: Column, subscribed: Column, churned: Column) -> Column:
    active = account.isNotNull() & active_subscription(day, subscribed, churned)
    return F.when(active, "subscriber").when(account.isNotNull(), "registered").otherwise("anonymous")


def reader_tier(day: Column, account: Column, subscribed: Column, churned: Column, tier: Column) -> Column:
    active = account.isNotNull() & active_subscription(day, subscribed, churned)
    return F.when(active, F.coalesce(tier, F.lit("unknown"))).otherwise("n/a")


def reader_state(login: Column) -> Column:
    return F.when(login.isNotNull(), "registered").otherwise("anonymous")


def micros_to_timestamp(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def micros_to_date(micros: Column) -> Column:
    return F.to_date(F.timestamp_micros(micros))
