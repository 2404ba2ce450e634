"""Default channel grouping and campaign repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell import fixed_values as fixed


def default_channel(source: Column, medium: Column, category: Column, campaign: Column) -> Column:
    """Channel of a visit. The first rule that holds wins; a null operand never holds."""
    paid = medium.rlike(fixed.PAID_MEDIUM_PATTERN)
    shopping = (category == fixed.CATEGORY_SHOPPING) | campaign.rlike(fixed.SHOPPING_CAMPAIGN_PATTERN)
    search = category == fixed.CATEGORY_SEARCH
    social = category == fixed.CATEGORY_SOCIAL
    video = category == fixed.CATEGORY_VIDEO
    untagged = source.isNull() & medium.isNull()
    direct = (source == fixed.DIRECT_SOURCE) & medium.isin(*fixed.DIRECT_MEDIA)
    push = (
        medium.rlike(fixed.PUSH_MEDIUM_PATTERN)
        | medium.rlike(fixed.MOBILE_MEDIUM_PATTERN)
        | (source == "firebase")
    )
    rules = [
        (untagged | direct, "Direct"),
        (campaign.rlike(fixed.CROSS_NETWORK_PATTERN), "Cross-network"),
        (shopping & paid, "Paid Shopping"),
        (search & paid, "Paid Search"),
        (social & paid, "Paid Social"),
        (video & paid, "Paid Video"),
        (medium.isin(*fixed.DISPLAY_MEDIA), "Display"),
        (paid, "Paid Other"),
        (shopping, "Organic Shopping"),
        (social | medium.isin(*fixed.SOCIAL_MEDIA), "Organic Social"),
        (video | medium.rlike(fixed.VIDEO_MEDIUM_PATTERN), "Organic Video"),
        (search | (medium == "organic"), "Organic Search"),
        (medium.isin(*fixed.REFERRAL_MEDIA), "Referral"),
        (source.rlike(fixed.EMAIL_PATTERN) | medium.rlike(fixed.EMAIL_PATTERN), "Email"),
        (medium == "affiliate", "Affiliates"),
        (medium == "audio", "Audio"),
        ((source == "sms") | (medium == "sms"), "SMS"),
        (push, "Mobile Push Notifications"),
    ]
    channel = F
    for holds, label in rules:
        channel = channel.when(holds, label)
    return channel.otherwise("Unassigned")


def gclid_repair(location: Column, source: Column, medium: Column, campaign: Column) -> dict[str, Column]:
    """Source, medium and campaign of hits whose URL carries an ad click id."""
    clicked = location.contains("gclid")
    no_medium = medium.isNull() | (medium == "organic")
    no_campaign = campaign.isNull() | campaign.isin("organic", "(organic)")
    return {
        "event_source": F.when(clicked & source.isNull(), "google").otherwise(source),
        "event_medium": F.when(clicked & no_medium, "cpc").otherwise(medium),
        "event_campaign": F.when(clicked & no_campaign, "(cpc)").otherwise(campaign),
    }


def or_none(value: Column) -> Column:
    return F.coalesce(value, F.lit(fixed.NO_MEDIUM))


def or_direct(value: Column) -> Column:
    return F.coalesce(value, F.lit(fixed.DIRECT_SOURCE))
