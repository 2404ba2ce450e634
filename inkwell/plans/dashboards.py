"""The named metric queries of the five dashboard pages."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from inkwell.plans.metrics import DateRange, MetricQuery, grain_for, metric_query
from inkwell.plans.warehouse import Warehouse


@dataclass(frozen=True)
class NamedQuery:
    """A metric query whose grain may follow the range, or that asks for its last day."""

    query: MetricQuery
    range_grain: bool = False
    last_day: bool = False


def _on(cube: str, measures: str, time: str, by: str | None = None, **more) -> NamedQuery:
    options = {k: more.pop(k) for k in ("range_grain", "last_day") if k in more}
    query = MetricQuery(
        [f"{cube}.{m}" for m in measures.split()],
        [f"{cube}.{by}"] if by else [],
        f"{cube}.{time}",
        **more,
    )
    return NamedQuery(query, **options)


NAMED_QUERIES: dict[str, NamedQuery] = {
    "overview.sessions": _on("sessions", "sessions activeUsers avgEngagedTimePerSession", "eventDate"),
    "overview.pageviews": _on("pages", "pageviews", "eventDate"),
    "overview.newSubs": _on("crm", "newSubscribers", "subscriptionDate"),
    "overview.paywall": _on("paywall", "impressions clicks ctr", "eventDate"),
    "overview.funnel": _on("paywallFunnel", "sessionsExposed paywallConversionRate", "eventDate"),
    "overview.trendQ": _on("sessions", "sessions pageviews", "eventDate", range_grain=True),
    "overview.channelsQ": _on("traffic", "sessions", "eventDate", "channelGrouping"),
    "overview.readersQ": _on("readerTypes", "articlePageviews", "eventDate", "readerType"),
    "audience.totals": _on(
        "sessions",
        "sessions activeUsers avgEngagedTimePerSession pageviewsPerSession sessionsPerUser",
        "eventDate",
    ),
    "audience.trendQ": _on("sessions", "sessions activeUsers", "eventDate", range_grain=True),
    "audience.channelsQ": _on(
        "traffic", "sessions pageviews engagedTime newsletterSignups", "eventDate", "channelGrouping"
    ),
    "audience.sourcesQ": _on("traffic", "sessions", "eventDate", "trafficSource"),
    "audience.countriesQ": _on("sessions", "sessions", "eventDate", "country"),
    "audience.devicesQ": _on("sessions", "sessions", "eventDate", "device"),
    "audience.campaignsQ": _on("traffic", "sessions pageviews newsletterSignups", "eventDate", "utmCampaign"),
    "content.totals": _on(
        "articles", "articlePageviews shares bookmarks comments avgScrollPercent", "eventDate"
    ),
    "content.publishedQ": _on("content", "articlesPublished", "publicationDate"),
    "content.inventoryQ": _on("contentTotals", "numberOfArticles", "asOfDate", last_day=True),
    "content.bySectionQ": _on("articles", "articlePageviews", "eventDate", "section"),
    "content.topArticlesQ": _on(
        "articles", "articlePageviews", "eventDate", "title", order_by="articles.articlePageviews", limit=10
    ),
    "content.readersQ": _on("readerTypes", "articlePageviews", "eventDate", "readerType"),
    "content.authorsQ": _on(
        "articles", "articlePageviews engagedTime shares bookmarks comments", "eventDate", "author"
    ),
    "paywall.totals": _on("paywall", "impressions clicks ctr", "eventDate"),
    "paywall.funnelTotals": _on(
        "paywallFunnel", "sessionsExposed paywallConversionRate newSubscribers", "eventDate"
    ),
    "paywall.byTypeQ": _on("paywall", "impressions clicks ctr", "eventDate", "paywallType"),
    "paywall.byOfferQ": _on("paywall", "impressions clicks", "eventDate", "bundleOffer"),
    "paywall.trendQ": _on("paywallFunnel", "impressions clicks ctr", "eventDate", range_grain=True),
    "subscriptions.newSubsQ": _on("crm", "newSubscribers", "subscriptionDate"),
    "subscriptions.churnsQ": _on("crm", "newChurns", "churnDate"),
    "subscriptions.registeredQ": _on("crm", "newRegisteredUsers", "registrationDate"),
    "subscriptions.totalsQ": _on(
        "crmTotals", "numberOfSubscribers numberOfRegisteredUsers cumulativeChurns", "asOfDate", last_day=True
    ),
    "subscriptions.funnelQ": _on("paywallFunnel", "sessionsExposed paywallConversionRate", "eventDate"),
    "subscriptions.subsTrendQ": _on("crm", "newSubscribers", "subscriptionDate", range_grain=True),
    "subscriptions.churnTrendQ": _on("crm", "newChurns", "churnDate", range_grain=True),
    # Starts only: churn does not lower this series.
    "subscriptions.cumulativeQ": _on("crmTotals", "cumulativeSubscribers", "asOfDate", range_grain=True),
    "subscriptions.tierQ": _on("subscriptions", "newSubscribers", "subscriptionDate", "tier"),
    "subscriptions.channelQ": _on("subscriptions", "newSubscribers", "subscriptionDate", "channelGrouping"),
    "subscriptions.pathQ": _on(
        "subscriptions", "newSubscribers", "subscriptionDate", "convertedOnFirstWallSession"
    ),
    "subscriptions.journeyQ": _on(
        "subscriptions", "medianPriorWallImpressions medianDaysFirstWallToSub", "subscriptionDate"
    ),
}


def named_query(w: Warehouse, name: str, range_: DateRange) -> DataFrame:
    """Result of one named query over a range of days."""
    named = NAMED_QUERIES[name]
    query = replace(named.query, grain=grain_for(range_)) if named.range_grain else named.query
    return metric_query(w, query, range_.last_day() if named.last_day else range_)
