"""One SQL string per registered query. Column lists carry a type letter each:
d date as text, s as it is, i whole number, f rounded number, t timestamp as micros."""

from __future__ import annotations

from oracle.relations import (
    EVENT_VALUES,
    FIRST_VALUES,
    LAST_NON_DIRECT,
    SESSION_SOURCE,
    over_relations,
)

RANGE = ("2024-01-03", "2024-01-27")
WIDE_RANGE = ("2023-12-20", "2024-02-10")
PREVIOUS_RANGE = ("2024-01-01", "2024-01-15")
CURRENT_RANGE = ("2024-01-16", "2024-01-30")

_CAST = {
    "d": "CAST({} AS VARCHAR)",
    "s": "{}",
    "i": "CAST({} AS BIGINT)",
    "f": "round(CAST({} AS DOUBLE), 6)",
    "t": "epoch_us({})",
}


def cols(spec: str) -> str:
    """``d day; i a b; f ratio`` as a select list."""
    parts = []
    for group in spec.split(";"):
        kind, *names = group.split()
        parts += [f"{_CAST[kind].format(n)} AS {n}" for n in names]
    return ", ".join(parts)


def rel(relation: str, spec: str, tail: str = "") -> str:
    return over_relations(f"SELECT {cols(spec)} FROM {relation} {tail}")


_CMS = "s title section author; t published_at; i word_count; s is_breaking has_video"
_ARTICLE_METRICS = (
    "i page_views distinct_client_keys new_client_keys entrances scroll_events share_events bookmark_events "
    "comment_events video_starts video_completes engagement_time_msec newsletter_signups; f avg_scroll_percent"
)
_WHOLE = {"device_time_zone_offset_seconds", "session_partition_start_timestamp"}


def _typed(names) -> str:
    whole = [n for n in names if n.removeprefix("first_").removeprefix("last_") in _WHOLE]
    rest = [n for n in names if n not in whole]
    return f"s {' '.join(rest)}" + (f"; i {' '.join(whole)}" if whole else "")


_M1 = f"s client_key session_partition_key non_direct_session_partition_key; d session_partition_date; " \
      f"i session_partition_timestamp; s {' '.join(SESSION_SOURCE)}"
_M2 = f"{_M1}; s session_partition_key_last_non_direct {' '.join(LAST_NON_DIRECT)}"
_M11 = (
    "s session_key client_key stream_id user_id session_partition_key; d session_partition_date; "
    "i session_partition_min_timestamp session_partition_count_page_views session_partition_max_session_engaged "
    "session_partition_sum_engagement_time_msec session_number newsletter_signup_count; "
    "f session_partition_sum_event_value_in_usd"
)
_CLIENT_TOTALS = (
    "i first_seen_timestamp count_pageviews count_engaged_sessions sum_engaged_time_msec count_sessions "
    "count_newsletter_signup; d first_seen_start_date; f sum_event_value_in_usd"
)
_PLACE = "s platform device_category device_operating_system device_browser geo_country geo_region geo_city"
_STAGED = (
    "i event_timestamp row_id session_id session_number; d event_date_dt; s event_name client_key session_key "
    "session_partition_key user_id page_location page_referrer page_path page_hostname page_query_string page_key "
    "event_source event_medium event_campaign event_content event_term"
)


def _event(select: str, name: str) -> str:
    return over_relations(
        f"SELECT row_id, event_timestamp, client_key{', ' + select if select else ''} "
        f"FROM stg WHERE event_name = '{name}'"
    )


_VIDEO = (
    "CAST(article AS VARCHAR) AS a_, 120 AS video_duration, {p} AS video_percent, "
    "CAST(floor({p} * 120 / 100) AS BIGINT) AS video_current_time, 'https://video.example/' || article AS video_url, "
    "'youtube' AS video_provider, 'Clip ' || article AS video_title, '1' AS visible"
).replace("CAST(article AS VARCHAR) AS a_, ", "").replace("120 AS video_duration", "CAST(120 AS BIGINT) AS video_duration")


def _video(name: str, percent: str) -> str:
    return _event(_VIDEO.format(p=f"CAST({percent} AS BIGINT)"), name)


_ART_TEXT = "CAST(article AS VARCHAR) AS article_id"
_ENTRANCES = "CAST(CASE WHEN entrance THEN 1 END AS BIGINT) AS entrances"
_NO_ENTRANCES = "CAST(NULL AS BIGINT) AS entrances"
_NO_VALUE = "CAST(NULL AS DOUBLE) AS value"

EVENT_TYPES = {
    "e02_page_view": _event(
        f"{_ENTRANCES}, round(k * 0.5, 6)::DOUBLE AS value, {_ART_TEXT}, 'section-' || (article % 4) AS section, "
        "'/news' AS pagepath_level_1, '/' || split_part(split_part(page_location, '/', 5), '?', 1) AS pagepath_level_2, "
        "CAST(NULL AS VARCHAR) AS pagepath_level_3, CAST(NULL AS VARCHAR) AS pagepath_level_4, "
        "md5(session_key || page_location) AS page_engagement_key",
        "page_view",
    ),
    "e03_session_start": _event(f"{_NO_ENTRANCES}, {_NO_VALUE}", "session_start"),
    "e04_first_visit": _event("page_location AS landing_page", "first_visit"),
    "e05_user_engagement": _event("CAST(engagement_time_msec AS BIGINT) AS engagement_time_msec, "
                                  "CAST(session_engaged AS BIGINT) AS session_engaged", "user_engagement"),
    "e06_scroll": _event(f"CAST(percent_scrolled AS BIGINT) AS percent_scrolled, {_ART_TEXT}", "scroll"),
    "e07_click": _event(
        f"{_NO_ENTRANCES}, 'true' AS outbound, 'https://partner.example/' || k AS link_url, "
        "'partner.example' AS link_domain, 'link_classes-' || (k % 3) AS link_classes, "
        "'link_id-' || (k % 3) AS link_id, 'click_element-' || (k % 3) AS click_element, "
        "'click_region-' || (k % 3) AS click_region, 'click_tag_name-' || (k % 3) AS click_tag_name, "
        "'click_url-' || (k % 3) AS click_url, 'file_name-' || (k % 3) AS file_name",
        "click",
    ),
    "e08_file_download": _event(
        f"{_NO_ENTRANCES}, {_NO_VALUE}, 'pdf' AS file_extension, 'report-' || k || '.pdf' AS file_name, "
        "'partner.example' AS link_domain, 'https://partner.example/' || k AS link_url, 'Download' AS link_text, "
        "'link_classes-' || (k % 3) AS link_classes, 'link_id-' || (k % 3) AS link_id",
        "file_download",
    ),
    "e09_video_start": _video("video_start", "0"),
    "e10_video_progress": _video("video_progress", "(k % 3 + 1) * 25"),
    "e11_video_complete": _video("video_complete", "100"),
    "e12_view_search_results": _event(
        f"{_NO_ENTRANCES}, 'term-' || (k % 20) AS search_term, '1' AS unique_search_term", "view_search_results"
    ),
    "e13_search": _event("'term-' || (k % 20) AS search_term", "search"),
    "e14_share": _event(
        "CASE k % 3 WHEN 0 THEN 'copy' WHEN 1 THEN 'email' ELSE 'x' END AS method, 'article' AS content_type, "
        "CAST(article AS VARCHAR) AS item_id",
        "share",
    ),
    "e15_custom_event": _event(
        "paywall_type AS wall, bundle_offer, CAST(article AS VARCHAR) AS article_id", "subscribe"
    ),
    "e16_bookmark": _event(_ART_TEXT, "bookmark"),
    "e17_comment": _event(_ART_TEXT, "comment"),
    "e18_newsletter_signup": _event(
        "CASE WHEN k % 2 = 1 THEN 'popup' ELSE 'footer' END AS method", "newsletter_signup"
    ),
    "e19_paywall_impression": _event("", "paywall_impression"),
    "e20_paywall_click": _event("", "paywall_click"),
}

# The cubes: relation, time columns and SQL of every member.
_SECONDS = "sum({}) / 1000.0"
_SESSIONS, _CLIENTS = "count(DISTINCT session_key)", "count(DISTINCT client_key)"
_CHANNELS = {
    "channelGrouping": "session_default_channel_grouping",
    "trafficSource": "session_source",
    "sourceMedium": "session_medium",
    "utmCampaign": "session_campaign",
    "utmContent": "session_content",
    "lastNonDirectSource": "last_non_direct_source",
    "lastNonDirectMedium": "last_non_direct_medium",
    "lastNonDirectChannelGrouping": "last_non_direct_default_channel_grouping",
}
_ARTICLE = {
    "articleId": "article_id",
    "title": "title",
    "section": "section",
    "author": "author",
    "wordCount": "word_count",
    "publicationDate": "published_at",
    "isBreaking": "is_breaking",
    "hasVideo": "has_video",
}
CUBES = {
    "articles": (
        "m17",
        {
            "articlePageviews": "i sum(page_views)",
            "readers": "i sum(distinct_client_keys)",
            "newReaders": "i sum(new_client_keys)",
            "entrances": "i sum(entrances)",
            "scrollEvents": "i sum(scroll_events)",
            "avgScrollPercent": "f avg(avg_scroll_percent)",
            "shares": "i sum(share_events)",
            "bookmarks": "i sum(bookmark_events)",
            "comments": "i sum(comment_events)",
            "videoStarts": "i sum(video_starts)",
            "videoCompletes": "i sum(video_completes)",
            "engagedTime": "f " + _SECONDS.format("engagement_time_msec"),
            "newsletterSignups": "i sum(newsletter_signups)",
        },
        {**_ARTICLE, "eventDate": "event_date_dt"},
    ),
    "content": ("art", {"articlesPublished": "i count(*)"}, _ARTICLE),
    "contentTotals": ("content_totals", {"numberOfArticles": "i max(articles_total)"}, {"asOfDate": "as_of_date"}),
    "crm": (
        "acc",
        {
            "newRegisteredUsers": "i count(*)",
            "newSubscribers": "i count(*) FILTER (WHERE subscription_date IS NOT NULL)",
            "newChurns": "i count(*) FILTER (WHERE churn_date IS NOT NULL)",
        },
        {
            "country": "country",
            "tier": "subscription_tier",
            "registrationDate": "registration_date",
            "subscriptionDate": "subscription_date",
            "churnDate": "churn_date",
        },
    ),
    "crmTotals": (
        "crm_totals",
        {
            "numberOfRegisteredUsers": "i max(registered_total)",
            "cumulativeSubscribers": "i max(subscriber_starts_total)",
            "cumulativeChurns": "i max(churned_total)",
            "numberOfSubscribers": "i arg_max(active_subscribers_total, as_of_date)",
        },
        {"asOfDate": "as_of_date"},
    ),
    "events": (
        "event_state",
        {
            "eventsCount": "i count(*)",
            "activeUsers": f"i {_CLIENTS}",
            "activeRegisteredUsers": "i count(DISTINCT user_id)",
            "activeAccounts": "i count(DISTINCT account)",
            "activeSubscribers": "i count(DISTINCT CASE WHEN active THEN user_id END)",
        },
        {"eventName": "event_name", "eventDate": "event_date", "url": "page_location"},
    ),
    "pages": (
        "m16",
        {
            "pageviews": "i sum(page_views)",
            "entrances": "i sum(entrances)",
            "engagedTime": "f " + _SECONDS.format("total_engagement_time_msec"),
            "scrollEvents": "i sum(scroll_events)",
        },
        {"url": "page_location", "eventDate": "event_date_dt"},
    ),
    "paywall": (
        "m19",
        {
            "impressions": "i sum(paywall_impressions)",
            "clicks": "i sum(paywall_clicks)",
            "ctr": "f sum(paywall_clicks) / nullif(sum(paywall_impressions), 0)",
        },
        {
            "paywallType": "paywall_type",
            "bundleOffer": "bundle_offer",
            "articleId": "article_id",
            "eventDate": "event_date_dt",
        },
    ),
    "paywallFunnel": (
        "funnel",
        {
            "sessionsExposed": "i sum(sessions_exposed)",
            "impressions": "i sum(impressions)",
            "clicks": "i sum(clicks)",
            "newSubscribers": "i sum(new_subscribers)",
            "paywallConversionRate": "f sum(new_subscribers) / nullif(sum(sessions_exposed), 0)",
            "ctr": "f sum(clicks) / nullif(sum(impressions), 0)",
        },
        {"eventDate": "event_date"},
    ),
    "paywallSessions": (
        "m20",
        {
            "sessionsWithPaywallImpression": "i count(*)",
            "impressions": "i sum(paywall_impressions)",
            "clicks": "i sum(paywall_clicks)",
        },
        {"eventDate": "event_date_dt"},
    ),
    "readerTypes": (
        "m18",
        {"articlePageviews": "i sum(page_views)", "engagedTime": "f " + _SECONDS.format("engagement_time_msec")},
        {
            "readerType": "reader_type",
            "subscriptionTier": "subscription_tier",
            "articleId": "article_id",
            "title": "title",
            "section": "section",
            "eventDate": "event_date_dt",
        },
    ),
    "sessions": (
        "visits",
        {
            "sessions": f"i {_SESSIONS}",
            "activeUsers": f"i {_CLIENTS}",
            "engagedSessions": "i sum(session_engaged_flag)",
            "pageviews": "i sum(page_view_count)",
            "engagedTime": "f " + _SECONDS.format("engagement_time_msec"),
            "avgEngagedTimePerUser": f"f sum(engagement_time_msec) / 1000.0 / nullif({_CLIENTS}, 0)",
            "avgEngagedTimePerSession": f"f sum(engagement_time_msec) / 1000.0 / nullif({_SESSIONS}, 0)",
            "pageviewsPerUser": f"f sum(page_view_count) / nullif({_CLIENTS}, 0)",
            "pageviewsPerSession": f"f sum(page_view_count) / nullif({_SESSIONS}, 0)",
            "sessionsPerUser": f"f {_SESSIONS} / nullif({_CLIENTS}, 0)",
        },
        {
            "eventDate": "session_partition_date",
            "country": "geo_country",
            "platform": "platform",
            "device": "device_category",
            "deviceOs": "device_operating_system",
            **_CHANNELS,
            "landingPage": "landing_page_path",
        },
    ),
    "subscriptions": (
        "m22",
        {
            "newSubscribers": "i count(*)",
            "conversionsLaterChurned": "i count(churn_date)",
            "avgPriorWallImpressions": "f avg(prior_wall_impressions)",
            "medianPriorWallImpressions": "f min(median_prior_wall_impressions)",
            "medianDaysFirstWallToSub": "f min(median_days_first_wall_to_sub)",
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
    "traffic": (
        "visits",
        {
            "sessions": f"i {_SESSIONS}",
            "pageviews": "i sum(page_view_count)",
            "engagedSessions": "i sum(session_engaged_flag)",
            "engagedTime": "f " + _SECONDS.format("engagement_time_msec"),
            "newsletterSignups": "i sum(newsletter_signup_count)",
            "activeUsers": f"i {_CLIENTS}",
            "avgEngagedTimePerSession": f"f sum(engagement_time_msec) / 1000.0 / nullif({_SESSIONS}, 0)",
        },
        {"eventDate": "session_partition_date", **_CHANNELS},
    ),
}
_DATES = {"registrationDate", "subscriptionDate", "churnDate", "eventDate", "asOfDate"}
_NUMBERS = {"articleId", "wordCount", "paywallArticleId", "priorWallImpressions"}


def cube_select(
    cube: str,
    measures: str | None = None,
    dimensions: str = "",
    time: str | None = None,
    range_: tuple[str, str] | None = None,
    grain: str | None = None,
    tail: str = "",
) -> str:
    relation, all_measures, all_dimensions = CUBES[cube]
    select, keys = [], []
    for name in dimensions.split():
        column = all_dimensions[name]
        kind = "d" if name in _DATES else "t" if name == "publicationDate" else "i" if name in _NUMBERS else "s"
        select.append(f"{_CAST[kind].format(column)} AS \"{name}\"")
        keys.append(column)
    if grain:
        bucket = f"CAST(date_trunc('{grain}', {all_dimensions[time]}) AS DATE)"
        select.append(f"CAST({bucket} AS VARCHAR) AS \"{time}\"")
        keys.append(bucket)
    for name in (measures.split() if measures else all_measures):
        kind, _, sql = all_measures[name].partition(" ")
        select.append(f"{_CAST[kind].format(sql)} AS \"{name}\"")
    where = f"WHERE CAST({all_dimensions[time]} AS DATE) BETWEEN DATE '{range_[0]}' AND DATE '{range_[1]}'" if range_ else ""
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    return f"SELECT {', '.join(select)} FROM {relation} {where} {group} {tail}"


_DAY = ("2024-01-27", "2024-01-27")
_TOP = 'ORDER BY "articlePageviews" DESC, title LIMIT 10'
# Cube, measures, dimension, time dimension, range, grain, tail.
NAMED = {
    "overview.sessions": ("sessions", "sessions activeUsers avgEngagedTimePerSession", "", "eventDate", RANGE),
    "overview.pageviews": ("pages", "pageviews", "", "eventDate", RANGE),
    "overview.newSubs": ("crm", "newSubscribers", "", "subscriptionDate", RANGE),
    "overview.paywall": ("paywall", "impressions clicks ctr", "", "eventDate", RANGE),
    "overview.funnel": ("paywallFunnel", "sessionsExposed paywallConversionRate", "", "eventDate", RANGE),
    "overview.trendQ": ("sessions", "sessions pageviews", "", "eventDate", WIDE_RANGE, "week"),
    "overview.channelsQ": ("traffic", "sessions", "channelGrouping", "eventDate", RANGE),
    "overview.readersQ": ("readerTypes", "articlePageviews", "readerType", "eventDate", RANGE),
    "audience.totals": (
        "sessions",
        "sessions activeUsers avgEngagedTimePerSession pageviewsPerSession sessionsPerUser",
        "",
        "eventDate",
        RANGE,
    ),
    "audience.trendQ": ("sessions", "sessions activeUsers", "", "eventDate", RANGE, "day"),
    "audience.channelsQ": (
        "traffic",
        "sessions pageviews engagedTime newsletterSignups",
        "channelGrouping",
        "eventDate",
        RANGE,
    ),
    "audience.sourcesQ": ("traffic", "sessions", "trafficSource", "eventDate", RANGE),
    "audience.countriesQ": ("sessions", "sessions", "country", "eventDate", RANGE),
    "audience.devicesQ": ("sessions", "sessions", "device", "eventDate", RANGE),
    "audience.campaignsQ": ("traffic", "sessions pageviews newsletterSignups", "utmCampaign", "eventDate", RANGE),
    "content.totals": (
        "articles",
        "articlePageviews shares bookmarks comments avgScrollPercent",
        "",
        "eventDate",
        RANGE,
    ),
    "content.publishedQ": ("content", "articlesPublished", "", "publicationDate", RANGE),
    "content.inventoryQ": ("contentTotals", "numberOfArticles", "", "asOfDate", _DAY),
    "content.bySectionQ": ("articles", "articlePageviews", "section", "eventDate", RANGE),
    "content.topArticlesQ": ("articles", "articlePageviews", "title", "eventDate", RANGE, None, _TOP),
    "content.readersQ": ("readerTypes", "articlePageviews", "readerType", "eventDate", RANGE),
    "content.authorsQ": (
        "articles",
        "articlePageviews engagedTime shares bookmarks comments",
        "author",
        "eventDate",
        RANGE,
    ),
    "paywall.totals": ("paywall", "impressions clicks ctr", "", "eventDate", RANGE),
    "paywall.funnelTotals": (
        "paywallFunnel",
        "sessionsExposed paywallConversionRate newSubscribers",
        "",
        "eventDate",
        RANGE,
    ),
    "paywall.byTypeQ": ("paywall", "impressions clicks ctr", "paywallType", "eventDate", RANGE),
    "paywall.byOfferQ": ("paywall", "impressions clicks", "bundleOffer", "eventDate", RANGE),
    "paywall.trendQ": ("paywallFunnel", "impressions clicks ctr", "", "eventDate", RANGE, "day"),
    "subscriptions.newSubsQ": ("crm", "newSubscribers", "", "subscriptionDate", RANGE),
    "subscriptions.churnsQ": ("crm", "newChurns", "", "churnDate", RANGE),
    "subscriptions.registeredQ": ("crm", "newRegisteredUsers", "", "registrationDate", RANGE),
    "subscriptions.totalsQ": (
        "crmTotals",
        "numberOfSubscribers numberOfRegisteredUsers cumulativeChurns",
        "",
        "asOfDate",
        _DAY,
    ),
    "subscriptions.funnelQ": ("paywallFunnel", "sessionsExposed paywallConversionRate", "", "eventDate", RANGE),
    "subscriptions.subsTrendQ": ("crm", "newSubscribers", "", "subscriptionDate", WIDE_RANGE, "week"),
    "subscriptions.churnTrendQ": ("crm", "newChurns", "", "churnDate", WIDE_RANGE, "week"),
    "subscriptions.cumulativeQ": ("crmTotals", "cumulativeSubscribers", "", "asOfDate", WIDE_RANGE, "week"),
    "subscriptions.tierQ": ("subscriptions", "newSubscribers", "tier", "subscriptionDate", RANGE),
    "subscriptions.channelQ": ("subscriptions", "newSubscribers", "channelGrouping", "subscriptionDate", RANGE),
    "subscriptions.pathQ": (
        "subscriptions",
        "newSubscribers",
        "convertedOnFirstWallSession",
        "subscriptionDate",
        RANGE,
    ),
    "subscriptions.journeyQ": (
        "subscriptions",
        "medianPriorWallImpressions medianDaysFirstWallToSub",
        "",
        "subscriptionDate",
        RANGE,
    ),
}


def named_key(number: int, name: str) -> str:
    return f"d{number:02d}_{name.replace('.', '_')}"


def _sub(cube: str, *args, **kw) -> str:
    return f"({cube_select(cube, *args, **kw)})"


def _check(name: str, level: str, failures: str) -> str:
    passed = "true" if level == "warn" else f"({failures}) = 0"
    return (
        f"SELECT '{name}' AS \"check\", '{level}' AS level, CAST(({failures}) AS BIGINT) AS failures, {passed} AS passed"
    )


def _all_checks() -> list[str]:
    """relation, its name here, columns without nulls, unique key, allowed values."""
    declared = [
        ("articles", "art", "", "article_id", {}),
        ("accounts", "acc", "", "user_id", {}),
        ("staged_events", "stg", "", "row_id", {}),
        ("client_dimension", "m15", "", "client_key", {}),
        ("client_facts", "m13", "", "client_key", {}),
        ("articles_daily", "m17", "event_date_dt article_id page_views", "", {}),
        (
            "articles_by_reader_type", "m18", "event_date_dt article_id reader_type subscription_tier page_views",
            "event_date_dt, article_id, reader_type, subscription_tier",
            {"reader_type": "'subscriber', 'registered', 'anonymous'"},
        ),
        ("traffic_sources_daily", "m21", "session_partition_date sessions", "", {}),
        (
            "subscription_last_touch", "m22", "user_id subscription_date subscription_tier", "user_id",
            {"subscription_source": "'subscribe_event', 'crm_only'",
             "last_article_reader_state": "'registered', 'anonymous'"},
        ),
        (
            "paywall_daily", "m19",
            "event_date_dt article_id paywall_type bundle_offer paywall_impressions paywall_clicks", "",
            {"paywall_type": "'hard', 'metered'", "bundle_offer": "'digital-only', 'basic', 'premium'"},
        ),
        (
            "paywall_sessions_daily", "m20", "event_date_dt session_partition_key paywall_impressions",
            "event_date_dt, session_partition_key", {},
        ),
    ]
    out = []
    for relation, here, filled, key, accepted in declared:
        counts = {f"not_null {c}": f"SELECT count(*) FROM {here} WHERE {c} IS NULL" for c in filled.split()}
        counts |= {
            f"accepted_values {c}": f"SELECT count(*) FROM {here} WHERE {c} NOT IN ({values})"
            for c, values in accepted.items()
        }
        if key:
            shown = "event_key" if key == "row_id" else key
            counts[f"unique {shown}"] = (
                f"SELECT count(*) FROM (SELECT 1 FROM {here} WHERE coalesce({', '.join(f'CAST({k} AS VARCHAR)' for k in key.split(', '))}) "
                f"IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
            )
        out += [
            f"SELECT '{relation}' AS relation, '{check}' AS \"check\", ({sql}) AS failures, ({sql}) = 0 AS passed"
            for check, sql in counts.items()
        ]
    return out


_CURRENT = _sub("sessions", "sessions activeUsers pageviews", "", "eventDate", CURRENT_RANGE)
_PREVIOUS = _sub("sessions", "sessions activeUsers pageviews", "", "eventDate", PREVIOUS_RANGE)
_CHANGES = ", ".join(
    f"c.{n} AS {n}_current, p.{n} AS {n}_previous, round((c.{n} - p.{n}) / nullif(p.{n}, 0), 6) AS {n}_change"
    for n in ("sessions", "activeUsers", "pageviews")
)
_LND_WINDOW = "session_partition_date BETWEEN DATE '2024-01-27' AND DATE '2024-01-30'"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["i01_late_window_rebuild"] = rel("m11", _M11)
    q["i02_scan_from_date"] = over_relations(
        "SELECT CAST(event_date_dt AS VARCHAR) AS event_date_dt, event_name, "
        "count(*) + count(*) FILTER (WHERE row_id % 970 = 5) AS hits "
        "FROM stg WHERE event_date_dt >= DATE '2024-01-20' GROUP BY 1, 2"
    )
    q["i03_articles"] = rel("art", f"i article_id; {_CMS}")
    q["i04_accounts"] = rel(
        "acc",
        "s user_id user_pseudo_id country is_subscriber subscription_tier; "
        "d registration_date subscription_date churn_date",
    )
    q["i06_full_rebuild"] = rel("m20", "d event_date_dt; s session_partition_key; i paywall_impressions paywall_clicks")
    q["i08_widened_lookback"] = rel("m2", _M2, f"WHERE {_LND_WINDOW}")
    q["p01_parameters"] = over_relations(
        "SELECT row_id, CAST(session_id AS BIGINT) AS session_id, session_number, page_location, page_referrer, "
        "CAST(session_engaged AS BIGINT) AS session_engaged, CAST(engagement_time_msec AS BIGINT) AS engagement_time_msec, "
        "CASE WHEN event_name = 'page_view' THEN 'Article ' || article END AS page_title, raw_source AS event_source, "
        "raw_medium AS event_medium, raw_campaign AS event_campaign, raw_content AS event_content, raw_term AS event_term, "
        "CASE WHEN event_name = 'page_view' THEN CAST(k * 0.5 AS DOUBLE) END AS value FROM stg"
    )
    q["p04_records"] = over_relations(
        "SELECT row_id, CASE WHEN number % 50 = 49 THEN 'No' ELSE 'Yes' END AS privacy_info_analytics_storage, "
        "'Yes' AS privacy_info_ads_storage, 'No' AS privacy_info_uses_transient_token, "
        "'0' AS user_ltv_revenue, 'USD' AS user_ltv_currency, "
        + "".join(
            f"CASE WHEN k = -1 THEN '{f}-' || (number % 3) END AS app_info_{f}, "
            for f in ("id", "version", "install_source", "firebase_app_id")
        )
        + "".join(
            f"CASE WHEN event_name = 'page_view' AND page_location LIKE '%gclid%' THEN '{f}-' || (k % 3) END "
            f"AS collected_traffic_source_{f}, "
            for f in (
                "manual_campaign_id", "manual_campaign_name", "manual_source", "manual_medium", "manual_term",
                "manual_content", "manual_source_platform", "manual_creative_format", "manual_marketing_tactic",
                "dclid", "srsltid",
            )
        )
        +         "CASE WHEN event_name = 'page_view' AND page_location LIKE '%gclid%' THEN 'g' || k END "
        "AS collected_traffic_source_gclid, " + cols(_typed(EVENT_VALUES)) + " FROM stg"
    )
    q["p10_keys"] = over_relations(
        "SELECT row_id, client_key, session_key, session_partition_key, page_key, "
        "md5(session_key || page_location) AS page_engagement_key, CAST(1 AS BIGINT) AS hits_with_event_key FROM stg"
    )
    q["p24_column_names"] = over_relations(
        "SELECT session_key, session_partition_key, strftime(min(event_date_dt), '%Y-%m-%d') AS session_partition_date, "
        "count(*) FILTER (WHERE event_name = 'newsletter_signup') AS newsletter_signup_count, "
        "count(*) FILTER (WHERE event_name = 'share') AS _4th_sign_up_count "
        "FROM stg GROUP BY session_key, session_partition_key"
    )
    q["i05_source_categories"] = over_relations(
        "SELECT DISTINCT cat.source, cat.source_category FROM stg JOIN cat ON stg.raw_source = cat.source"
    )
    q["p11_gclid_repair"] = over_relations(
        "SELECT row_id, event_source, event_medium, event_campaign FROM stg WHERE page_location LIKE '%gclid%'"
    )
    q["p12_url_parts"] = over_relations(
        "SELECT row_id, page_path, page_hostname, page_query_string, "
        "regexp_replace(page_location, '[?&#](id|gclid)=[^?&#]*', '', 'g') AS without_ids, "
        "regexp_replace(page_location, '[?&#].*', '') AS without_query, "
        "CASE WHEN contains(page_location, 'utm_source=') THEN 'x' END AS utm_source, "
        "CASE WHEN article IS NOT NULL THEN '/news' END AS level_1, "
        "CASE WHEN article IS NOT NULL THEN '/article-' || article END AS level_2, "
        "CAST(NULL AS VARCHAR) AS level_3 FROM stg"
    )
    q["p19_channels"] = over_relations(
        "SELECT event_source, event_medium, source_category, event_campaign, channel, count(*) AS hits FROM "
        "(SELECT event_source, event_medium, source_category, event_campaign, " + _channel() + " AS channel "
        "FROM stg LEFT JOIN cat ON event_source = cat.source) GROUP BY ALL"
    )
    q["p20_article_of_hit"] = over_relations(
        "SELECT row_id, CAST(article_id AS BIGINT) AS article_id FROM stg WHERE article_id IS NOT NULL "
        "AND event_name IN (SELECT DISTINCT event_name FROM reads)"
    )
    q["p21_reader_of_hit"] = over_relations("SELECT row_id, reader_type, subscription_tier FROM classified")
    q["e00_base_events"] = over_relations(
        "SELECT row_id, event_timestamp, event_name, user_id, user_pseudo_id, stream_id, "
        "CAST(event_date_dt AS VARCHAR) AS event_date_dt, CAST(session_id AS BIGINT) AS session_id, "
        "CAST(CASE WHEN event_name = 'page_view' THEN 1 ELSE 0 END AS BIGINT) AS is_page_view, "
        "CAST(0 AS BIGINT) AS is_purchase, CAST(1 AS BIGINT) AS property_id FROM stg"
    )
    q["e01_staged_events"] = rel("stg", _STAGED)
    q |= EVENT_TYPES
    q["g01_sessionise"] = over_relations(
        "SELECT event_id, user_id, CAST(sum(o) OVER (PARTITION BY user_id ORDER BY us, event_id "
        "ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_number FROM (SELECT event_id, user_id, us, "
        "CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) <= 1800000000 THEN 0 ELSE 1 END AS o "
        "FROM raw)"
    )
    q["m01_session_traffic_sources"] = rel("m1", _M1)
    q["m02_last_non_direct"] = rel("m2", _M2)
    q["m02_last_non_direct_30_days"] = rel("m2_month", _M2)
    q["m03_session_conversions"] = rel(
        "m3", "s session_key session_partition_key; d session_partition_date; i newsletter_signup_count"
    )
    q["m04_page_conversions"] = rel("m4", "s page_key; i newsletter_signup_count")
    q["m05_page_engaged_time"] = rel(
        "m5", "s page_engagement_key; f page_engagement_time_msec; i page_engagement_denominator"
    )
    q["m06_user_id_mapping"] = rel("m6", "s last_seen_user_id client_key; i last_seen_user_id_timestamp")
    q["m07_user_properties"] = rel("m7", "s client_key subscriber_status subscription_tier")
    ends = [f"{side}_{c}" for side in ("first", "last") for c in EVENT_VALUES]
    q["m08_client_first_last_events"] = rel("m8", f"s client_key stream_id; {_typed(ends)}")
    views = [f"{side}_page_{c}" for side in ("first", "last") for c in ("location", "hostname", "referrer")]
    q["m09_client_first_last_page_views"] = rel("m9", f"s client_key {' '.join(views)}")
    q["m10_session_dimension"] = rel(
        "m10",
        "s stream_id session_key session_partition_key; d session_partition_date; "
        f"{_typed(FIRST_VALUES)}; s {' '.join(SESSION_SOURCE + LAST_NON_DIRECT)}",
    )
    q["m11_session_facts_daily"] = rel("m11", _M11)
    q["m12_session_facts"] = rel(
        "m12",
        "s client_key session_key stream_id user_id; i session_start_timestamp count_pageviews is_session_engaged "
        "sum_engaged_time_msec session_number count_newsletter_signup; d session_start_date; f sum_event_value_in_usd",
    )
    q["m13_client_facts"] = rel("m13", f"s client_key stream_id; {_CLIENT_TOTALS}")
    q["m14_user_facts"] = rel("m14", f"s user_id_or_client_key stream_id; i is_user_id; {_CLIENT_TOTALS}")
    q["m15_client_dimension"] = rel(
        "m15", f"s client_key stream_id; {_typed(ends)}; s {' '.join(views)} subscriber_status subscription_tier"
    )
    q["m16_pages"] = rel(
        "m16",
        "d event_date_dt; s stream_id page_location page_key; i page_views distinct_client_keys new_client_keys "
        "entrances avg_engagement_time_denominator newsletter_signup_count scroll_events; f total_engagement_time_msec",
    )
    q["m17_articles_daily"] = rel("m17", f"d event_date_dt; i article_id; {_CMS}; {_ARTICLE_METRICS}")
    q["m18_articles_by_reader_type"] = rel(
        "m18", f"d event_date_dt; i article_id; s reader_type subscription_tier; {_CMS}; {_ARTICLE_METRICS}"
    )
    q["m19_paywall_daily"] = rel(
        "m19", "d event_date_dt; i article_id; s paywall_type bundle_offer; i paywall_impressions paywall_clicks"
    )
    q["m20_paywall_sessions_daily"] = q["i06_full_rebuild"]
    q["m21_traffic_sources_daily"] = rel(
        "m21",
        "d session_partition_date; s session_default_channel_grouping session_source session_medium "
        "last_non_direct_source last_non_direct_medium last_non_direct_default_channel_grouping; "
        "i sessions page_views engaged_sessions newsletter_signups engagement_time_msec",
    )
    rows = (
        "s user_id subscription_tier subscription_source paywall_article_title purchase_session_key "
        "purchased_same_day first_wall_session_key session_source session_medium session_campaign "
        "session_default_channel_grouping last_article_title last_article_section last_article_reader_state "
        "converted_on_first_wall_session; d subscription_date churn_date purchase_session_date; "
        "i paywall_article_id prior_wall_impressions days_first_wall_to_sub last_article_id "
        f"days_last_read_before_subscription; {_PLACE}; f median_prior_wall_impressions median_days_first_wall_to_sub"
    )
    q["m22_subscription_last_touch"] = over_relations(
        f"SELECT {cols(rows)}, subscription_ts AS subscription_timestamp, "
        "purchase_session_ts AS purchase_session_start, last_read_ts AS last_article_read_at FROM m22"
    )
    q["m22a_subscribers"] = rel("subs", "s user_id user_pseudo_id subscription_tier; d subscription_date churn_date")
    q["m22b_purchase_sessions"] = rel(
        "purchases",
        f"s user_id purchase_session_key; d purchase_session_date; i purchase_session_ts; {_PLACE}",
    )
    q["m22c_last_reads"] = rel("last_reads", "s user_id last_article_reader_state; i last_article_id last_read_ts")
    q["m22d_prior_walls"] = rel("prior_walls", "s user_id; i prior_wall_impressions")
    q["m22e_first_walls"] = rel("first_walls", "s user_id first_wall_session_key; i first_wall_ts")
    q["m22f_journey_medians"] = rel("medians", "f median_prior_wall_impressions median_days_first_wall_to_sub")
    q["m22g_conversion_flags"] = rel(
        "sub_rows",
        "s user_id purchased_same_day converted_on_first_wall_session; "
        "i days_first_wall_to_sub days_last_read_before_subscription",
    )
    q["m23_wall_policy"] = rel(
        "m23", "s client_key section wall; d event_date_dt; i event_timestamp article_id read_of_month"
    )
    for cube, (_, _, dimensions) in CUBES.items():
        snake = "".join("_" + c.lower() if c.isupper() else c for c in cube)
        q[f"cube_{snake}_measures"] = over_relations(cube_select(cube))
        first = next(iter(CUBES[cube][1]))
        q[f"cube_{snake}_dimensions"] = over_relations(cube_select(cube, first, " ".join(dimensions)))
    q["mq01_metric_query"] = over_relations(
        cube_select("traffic", "sessions pageviews", "channelGrouping trafficSource", "eventDate", RANGE, "month",
                    "ORDER BY sessions DESC, \"channelGrouping\", \"trafficSource\" LIMIT 5")
    )
    q["mq03_total"] = over_relations(cube_select("events", None, "", "eventDate", RANGE))
    q["mq04_trend"] = over_relations(
        'SELECT "eventDate" AS date, coalesce(sessions, 0) AS "Sessions", coalesce(pageviews, 0) AS "Pageviews" FROM '
        + _sub("sessions", "sessions pageviews", "", "eventDate", WIDE_RANGE, "week")
    )
    q["mq05_breakdown"] = over_relations(
        "SELECT coalesce(\"landingPage\", '—') AS name, pageviews AS value FROM "
        + _sub("sessions", "pageviews", "landingPage", "eventDate", RANGE)
        + " ORDER BY value DESC, name LIMIT 8"
    )
    q["mq06_breakdown_multi"] = over_relations(
        "SELECT coalesce(\"utmCampaign\", '—') AS name, sessions AS \"Sessions\", pageviews AS \"Pageviews\", "
        '"newsletterSignups" AS "Signups" FROM '
        + _sub("traffic", "sessions pageviews newsletterSignups", "utmCampaign", "eventDate", RANGE)
    )
    q["mq07_merge_trends"] = over_relations(
        "SELECT coalesce(a.\"subscriptionDate\", b.\"churnDate\") AS date, coalesce(\"newSubscribers\", 0) AS \"New\", "
        'coalesce("newChurns", 0) AS "Churned" FROM '
        + _sub("crm", "newSubscribers", "", "subscriptionDate", RANGE, "day")
        + " a FULL OUTER JOIN "
        + _sub("crm", "newChurns", "", "churnDate", RANGE, "day")
        + ' b ON a."subscriptionDate" = b."churnDate"'
    )
    q["mq08_period_change"] = over_relations(f"SELECT {_CHANGES} FROM {_CURRENT} c, {_PREVIOUS} p")
    q["mq09_wall_funnel"] = over_relations(
        "SELECT CAST(step AS BIGINT) AS step, label, value, round(value / greatest(impressions, 1), 6) AS share FROM ("
        "SELECT *, unnest([1, 2, 3]) AS step, unnest(['impressions', 'clicks', 'subscribers']) AS label, "
        'unnest([impressions, clicks, "newSubscribers"]) AS value FROM '
        + _sub("paywall", "impressions clicks", "", "eventDate", RANGE)
        + ", "
        + _sub("paywallFunnel", "newSubscribers", "", "eventDate", RANGE)
        + ")"
    )
    q["mq10_net_new_subscribers"] = over_relations(
        'SELECT "newSubscribers", "newChurns", "newSubscribers" - "newChurns" AS "netNew" FROM '
        + _sub("crm", "newSubscribers", "", "subscriptionDate", RANGE)
        + ", "
        + _sub("crm", "newChurns", "", "churnDate", RANGE)
    )
    q["mq11_first_wall_share"] = over_relations(
        'SELECT a AS "firstWall", b AS "laterWall", round(a / greatest(a + b, 1), 6) AS share FROM (SELECT '
        "count(*) FILTER (WHERE converted_on_first_wall_session) AS a, "
        "count(*) FILTER (WHERE NOT converted_on_first_wall_session) AS b FROM m22 WHERE subscription_date "
        f"BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}')"
    )
    q["mq12_event_state"] = over_relations(
        "SELECT CAST(event_date AS VARCHAR) AS event_date, event_name, count(*) AS hits, "
        "count(*) FILTER (WHERE active) AS active_hits, count(*) FILTER (WHERE account IS NOT NULL) AS account_hits "
        "FROM event_state GROUP BY 1, 2"
    )
    q["mq13_paywall_funnel"] = rel(
        "funnel", "d event_date; i sessions_exposed impressions clicks new_subscribers"
    )
    q["mq14_crm_totals"] = rel(
        "crm_totals",
        "d as_of_date; i registered_total subscriber_starts_total churned_total active_subscribers_total",
    )
    q["mq15_content_totals"] = rel("content_totals", "d as_of_date; i articles_total")
    for number, (name, spec) in enumerate(NAMED.items(), 1):
        q[named_key(number, name)] = over_relations(cube_select(*spec))
    q["t01_not_null"] = over_relations(
        _check("not_null client_key", "error", "SELECT count(*) FROM stg WHERE client_key IS NULL")
    )
    q["t02_unique"] = over_relations(
        _check("unique session_partition_key", "error", "SELECT count(*) - count(*) FROM m10")
    )
    q["t03_unique_combination"] = over_relations(
        _check(
            "unique event_date_dt, article_id, reader_type",
            "error",
            "SELECT count(*) FROM (SELECT 1 FROM m18 GROUP BY event_date_dt, article_id, reader_type HAVING count(*) > 1)",
        )
    )
    q["t04_accepted_values"] = over_relations(
        _check(
            "accepted_values subscription_tier",
            "error",
            "SELECT count(*) FROM m18 WHERE subscription_tier NOT IN ('digital-only', 'n/a')",
        )
    )
    q["t05_severity_warn"] = over_relations(
        _check("not_null page_referrer", "warn", "SELECT count(*) FROM stg WHERE page_referrer IS NULL")
    )
    totals = {
        "events.eventsCount": "count(*) FROM all_rows",
        "events.activeUsers": "count(DISTINCT number) FROM all_rows WHERE number % 50 <> 49",
        "events.activeRegisteredUsers": "count(DISTINCT user_id) FROM stg",
        "sessions.sessions": "count(DISTINCT session_key) FROM stg",
        "sessions.pageviews": "count(*) FROM pv WHERE session_key IS NOT NULL",
        "sessions.activeUsers": "count(DISTINCT client_key) FROM stg",
        "pages.pageviews": "count(*) FROM pv",
        "paywall.impressions": "sum(paywall_impressions) FROM m19",
        "paywall.clicks": "sum(paywall_clicks) FROM m19",
        "paywall.ctr": "round(sum(paywall_clicks) / sum(paywall_impressions), 6) FROM m19",
        "paywallFunnel.sessionsExposed": "count(*) FROM m20",
        "paywallFunnel.newSubscribers": "sum(new_subscribers) FROM funnel",
        "paywallFunnel.paywallConversionRate": "round(sum(new_subscribers) / sum(sessions_exposed), 6) FROM funnel",
        "crmTotals.numberOfRegisteredUsers": "max(registered_total) FROM crm_totals",
        "crmTotals.cumulativeSubscribers": "max(subscriber_starts_total) FROM crm_totals",
        "crmTotals.cumulativeChurns": "max(churned_total) FROM crm_totals",
        "crmTotals.numberOfSubscribers": "arg_max(active_subscribers_total, as_of_date) FROM crm_totals",
        "contentTotals.numberOfArticles": "max(articles_total) FROM content_totals",
        "articles.articlePageviews": "sum(page_views) FROM m17",
        "crm.newRegisteredUsers": "count(registration_date) FROM acc",
        "crm.newSubscribers": "count(subscription_date) FROM acc",
        "crm.newChurns": "count(churn_date) FROM acc",
        "subscriptions.newSubscribers": "count(subscription_date) FROM acc",
        "content.articlesPublished": "count(*) FROM art",
    }
    q["t06_control_totals"] = over_relations(
        "SELECT \"check\", total AS actual, total AS expected, true AS passed FROM ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS \"check\", CAST(({'SELECT ' + sql}) AS DOUBLE) AS total" for name, sql in totals.items()
        )
        + ")"
    )
    q["t07_reconciliation"] = over_relations(
        "SELECT 'pages and sessions' AS \"check\", a AS total, b AS other_total, c AS known_gap, a = b + c AS passed FROM "
        "(SELECT CAST(sum(page_views) AS BIGINT) AS a FROM m16), "
        "(SELECT CAST(sum(session_partition_count_page_views) AS BIGINT) AS b FROM m11), "
        "(SELECT count(*) AS c FROM pv WHERE session_key IS NULL)"
    )
    q["t08_all_checks"] = over_relations(" UNION ALL ".join(_all_checks()))
    for name, model in {
        "session_facts": "m11_session_facts_daily",
        "session_conversions": "m03_session_conversions",
        "changed_days": "m11_session_facts_daily",
        "user_id_mapping": "m06_user_id_mapping",
        "user_properties": "m07_user_properties",
        "client_first_last_events": "m08_client_first_last_events",
        "client_first_last_page_views": "m09_client_first_last_page_views",
        "sessions": "m12_session_facts",
        "client_facts": "m13_client_facts",
        "user_facts": "m14_user_facts",
        "client_dimension": "m15_client_dimension",
        "subscription_last_touch": "m22_subscription_last_touch",
        "session_dimension": "m10_session_dimension",
        "session_traffic_sources": "m01_session_traffic_sources",
        "last_non_direct": "m02_last_non_direct",
        "traffic_sources_daily": "m21_traffic_sources_daily",
        "pages": "m16_pages",
        "articles_daily": "m17_articles_daily",
        "articles_by_reader_type": "m18_articles_by_reader_type",
        "paywall_daily": "m19_paywall_daily",
        "paywall_sessions_daily": "m20_paywall_sessions_daily",
    }.items():
        q[f"i01_{name}"] = q[model]
    return q


def _channel() -> str:
    from oracle.relations import CHANNEL

    return CHANNEL
