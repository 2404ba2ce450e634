"""Shared relations of the oracle: the derived inputs and the marts, as CTEs."""

from __future__ import annotations

CATEGORIES = {
    "google": "SOURCE_CATEGORY_SEARCH",
    "facebook": "SOURCE_CATEGORY_SOCIAL",
    "youtube": "SOURCE_CATEGORY_VIDEO",
    "amazon": "SOURCE_CATEGORY_SHOPPING",
}
LOOKBACK_DAYS = 3
_ORDER = "event_timestamp, session_number, row_id"
_PAID = "regexp_matches(event_medium, '^(.*cp.*|ppc|retargeting|paid.*)$')"
_SHOP = (
    "(source_category = 'SOURCE_CATEGORY_SHOPPING' OR "
    "regexp_matches(event_campaign, '^(.*(([^a-df-z]|^)shop|shopping).*)$'))"
)
_ACTIVE = "(subscription_date <= event_date_dt AND (churn_date IS NULL OR churn_date > event_date_dt))"

CHANNEL = f"""CASE
  WHEN (event_source IS NULL AND event_medium IS NULL)
    OR (event_source = '(direct)' AND event_medium IN ('(none)', '(not set)')) THEN 'Direct'
  WHEN regexp_matches(event_campaign, 'cross-network') THEN 'Cross-network'
  WHEN {_SHOP} AND {_PAID} THEN 'Paid Shopping'
  WHEN source_category = 'SOURCE_CATEGORY_SEARCH' AND {_PAID} THEN 'Paid Search'
  WHEN source_category = 'SOURCE_CATEGORY_SOCIAL' AND {_PAID} THEN 'Paid Social'
  WHEN source_category = 'SOURCE_CATEGORY_VIDEO' AND {_PAID} THEN 'Paid Video'
  WHEN event_medium IN ('display', 'banner', 'expandable', 'interstitial', 'cpm') THEN 'Display'
  WHEN {_PAID} THEN 'Paid Other'
  WHEN {_SHOP} THEN 'Organic Shopping'
  WHEN source_category = 'SOURCE_CATEGORY_SOCIAL' OR event_medium IN
    ('social', 'social-network', 'social-media', 'sm', 'social network', 'social media') THEN 'Organic Social'
  WHEN source_category = 'SOURCE_CATEGORY_VIDEO' OR event_medium LIKE '%video%' THEN 'Organic Video'
  WHEN source_category = 'SOURCE_CATEGORY_SEARCH' OR event_medium = 'organic' THEN 'Organic Search'
  WHEN event_medium IN ('referral', 'app', 'link') THEN 'Referral'
  WHEN regexp_matches(event_source, 'email|e-mail|e_mail|e mail')
    OR regexp_matches(event_medium, 'email|e-mail|e_mail|e mail') THEN 'Email'
  WHEN event_medium = 'affiliate' THEN 'Affiliates'
  WHEN event_medium = 'audio' THEN 'Audio'
  WHEN event_source = 'sms' OR event_medium = 'sms' THEN 'SMS'
  WHEN event_medium LIKE '%push' OR regexp_matches(event_medium, 'mobile|notification')
    OR event_source = 'firebase' THEN 'Mobile Push Notifications'
  ELSE 'Unassigned' END"""


def _slot(name: str, values: tuple[str | None, ...]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE WHEN name = 'page_view' AND k % 5 = 0 THEN CASE (k // 5) % {len(values)} {cases} END END AS raw_{name}"


_CAMPAIGNS = {
    "source": (
        "google", "facebook", "mailchimp", "(direct)", "google", "google", "amazon", "facebook",
        "youtube", "news-site", "partner", "amazon", "youtube", "blog", "partner", "podcast", "sms",
        "app", "elsewhere", "blog",
    ),
    "medium": (
        "organic", "social", "email", "(none)", "cpc", "cpc", "cpc", "cpc", "cpc", "banner", "cpc",
        "referral", "referral", "referral", "affiliate", "audio", "sms", "push", "other", "link",
    ),
    "campaign": (
        None, None, "weekly-digest", None, "brand-awareness", "cross-network-1", None, None, None,
        "spring", None, None, None, None, "spring", None, None, None, None, None,
    ),
    "content": (
        None, "top-story", None, None, "ad-variant-a", None, None, "ad-variant-b", None, None, None,
        None, None, None, None, None, None, None, None, None,
    ),
    "term": (
        "news", None, None, None, "headlines", None, None, None, None, None, None, None, None, None,
        None, None, None, None, None, None,
    ),
}


_METRIC_SUMS = """
    count(*) FILTER (WHERE event_name = 'page_view') AS page_views,
    count(DISTINCT client_key) FILTER (WHERE event_name = 'page_view') AS distinct_client_keys,
    count(*) FILTER (WHERE event_name = 'page_view' AND session_number = 1) AS new_client_keys,
    count(*) FILTER (WHERE event_name = 'page_view' AND entrance) AS entrances,
    count(*) FILTER (WHERE event_name = 'scroll') AS scroll_events,
    avg(percent_scrolled) FILTER (WHERE event_name = 'scroll') AS avg_scroll_percent,
    count(*) FILTER (WHERE event_name = 'share') AS share_events,
    count(*) FILTER (WHERE event_name = 'bookmark') AS bookmark_events,
    count(*) FILTER (WHERE event_name = 'comment') AS comment_events,
    count(*) FILTER (WHERE event_name = 'video_start') AS video_starts,
    count(*) FILTER (WHERE event_name = 'video_complete') AS video_completes,
    coalesce(sum(engagement_time_msec) FILTER (WHERE event_name = 'user_engagement'), 0) AS engagement_time_msec,
    count(*) FILTER (WHERE event_name = 'newsletter_signup') AS newsletter_signups"""

_EVENT_VALUES = (
    "geo_continent geo_country geo_region geo_city geo_sub_continent geo_metro device_category "
    "device_mobile_brand_name device_mobile_model_name device_mobile_marketing_name "
    "device_mobile_os_hardware_model device_operating_system device_operating_system_version "
    "device_vendor_id device_advertising_id device_language device_is_limited_ad_tracking "
    "device_time_zone_offset_seconds device_browser device_browser_version device_web_info_browser "
    "device_web_info_browser_version device_web_info_hostname user_campaign user_medium user_source"
).split()
_NULL_TEXT = (
    "geo_continent geo_sub_continent geo_metro device_mobile_brand_name device_mobile_model_name "
    "device_mobile_marketing_name device_mobile_os_hardware_model device_operating_system_version "
    "device_vendor_id device_advertising_id device_browser_version device_web_info_browser_version"
).split()
FIRST_VALUES = {
    "session_partition_start_timestamp": "event_timestamp",
    "landing_page_path": "page_path",
    "landing_page_location": "page_location",
    "landing_page_hostname": "page_hostname",
    "referrer": "page_referrer",
    **{c: c for c in _EVENT_VALUES if c != "device_browser_version"},
    "platform": "platform",
}
EVENT_VALUES = _EVENT_VALUES
_SOURCE_FIELDS = ("source", "medium", "source_category", "campaign", "content", "term", "default_channel_grouping")
SESSION_SOURCE = [f"session_{f}" for f in _SOURCE_FIELDS]
LAST_NON_DIRECT = [f"last_non_direct_{f}" for f in _SOURCE_FIELDS]
_DEFAULT = {"source": "(direct)", "default_channel_grouping": "Direct"}

RELATIONS: dict[str, str] = {}

RELATIONS["raw"] = """
  SELECT event_id, user_id, epoch_us(ts) AS us, event_type,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events WHERE user_id IS NOT NULL"""
RELATIONS["named"] = """
  SELECT *, (event_id * 7 + k) % numbers AS article,
    'https://www.example.com/news/article-' || ((event_id * 7 + k) % numbers) ||
      CASE k % 10 WHEN 0 THEN '?gclid=g' || k WHEN 1 THEN '?utm_source=x&id=7#top' ELSE '' END AS location,
    CASE event_type
      WHEN 'view' THEN 'page_view'
      WHEN 'error' THEN 'user_engagement'
      WHEN 'click' THEN CASE WHEN k < 40 THEN 'paywall_impression' WHEN k < 55 THEN 'paywall_click'
        WHEN k < 75 THEN 'scroll' WHEN k < 85 THEN 'share' WHEN k < 93 THEN 'bookmark' ELSE 'comment' END
      WHEN 'signup' THEN CASE WHEN k < 60 THEN 'newsletter_signup' WHEN k < 64 THEN 'subscribe'
        WHEN k < 82 THEN 'video_start' ELSE 'video_complete' END
      ELSE CASE WHEN k < 60 THEN 'search' WHEN k < 80 THEN 'video_progress' WHEN k < 90 THEN 'click'
        WHEN k < 95 THEN 'file_download' ELSE 'view_search_results' END
    END AS raw_name
  FROM raw, (SELECT max(doc_id) + 3 AS numbers FROM documents)"""
RELATIONS["gaps"] = """
  SELECT *, CASE WHEN lag(us) OVER w IS NULL OR us - lag(us) OVER w > 43200000000 THEN 1 ELSE 0 END AS opens,
    row_number() OVER (PARTITION BY user_id, raw_name ORDER BY us, event_id) AS nth
  FROM named WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)"""
RELATIONS["numbered"] = """
  SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
      AS session_number,
    CASE WHEN raw_name = 'subscribe' AND NOT (user_id % 3 = 0 AND nth = 1) THEN 'newsletter_signup'
      ELSE raw_name END AS name
  FROM gaps"""
RELATIONS["hits!"] = """
  SELECT *, min(us) OVER (PARTITION BY user_id, session_number) AS first_us,
    min(event_id) OVER (PARTITION BY user_id, session_number) AS first_id,
    lag(location) OVER (PARTITION BY user_id, session_number ORDER BY us, event_id) AS referrer,
    name = 'page_view' AND row_number() OVER
      (PARTITION BY user_id, session_number, name ORDER BY us, event_id) = 1 AS entrance
  FROM numbered"""
RELATIONS["acc!"] = """
  SELECT CAST(user_id AS VARCHAR) AS user_id, 'u' || user_id AS user_pseudo_id,
    DATE '2024-01-01' + CAST(user_id % 10 AS INTEGER) AS registration_date,
    CASE user_id % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'United Kingdom' WHEN 2 THEN 'Canada'
      WHEN 3 THEN 'Germany' ELSE 'India' END AS country,
    sub IS NOT NULL AND NOT user_id % 5 = 0 AS is_subscriber,
    CASE WHEN sub IS NOT NULL THEN CASE user_id % 9 WHEN 0 THEN 'digital-only' WHEN 3 THEN 'basic'
      ELSE 'premium' END END AS subscription_tier,
    sub AS subscription_date,
    CASE WHEN user_id % 5 = 0 THEN sub + 7 END AS churn_date
  FROM (SELECT user_id, coalesce(
      max(CASE WHEN name = 'subscribe' THEN CAST(make_timestamp(us) AS DATE) END),
      CASE WHEN user_id % 12 = 0 THEN DATE '2024-01-10' + CAST(user_id % 15 AS INTEGER) END) AS sub
    FROM hits WHERE user_id % 3 = 0 GROUP BY user_id)"""
RELATIONS["art!"] = """
  SELECT CAST(doc_id AS INTEGER) AS article_id, 'Document ' || doc_id AS title,
    CASE doc_id % 4 WHEN 0 THEN 'politics' WHEN 1 THEN 'sports' WHEN 2 THEN 'culture' ELSE 'lifestyle' END AS section,
    'author-' || (doc_id % 12) AS author,
    TIMESTAMP '2023-12-25 08:00:00' + to_hours(CAST(doc_id % 1000 * 12 AS INTEGER)) AS published_at,
    CAST(floor(n_chars / 6) AS INTEGER) AS word_count, doc_id % 10 = 0 AS is_breaking, doc_id % 5 = 0 AS has_video
  FROM documents"""
RELATIONS["cat"] = "SELECT * FROM (VALUES " + ", ".join(f"('{s}', '{c}')" for s, c in CATEGORIES.items()) + (
    ") AS c(source, source_category)"
)
RELATIONS["all_rows"] = """
  SELECT event_id * 10 + 5 AS row_id, user_id AS number, us, k, article, location, session_number, first_us,
    referrer, entrance, name FROM hits
  UNION ALL SELECT first_id * 10 + 1, user_id, first_us, -1, NULL, 'https://www.example.com/', session_number,
    first_us, NULL, false, 'session_start' FROM hits WHERE opens = 1
  UNION ALL SELECT first_id * 10 + 2, user_id, first_us, -1, NULL, 'https://www.example.com/', session_number,
    first_us, NULL, false, 'first_visit' FROM hits WHERE opens = 1 AND session_number = 1"""
RELATIONS["flat"] = f"""
  SELECT row_id, number, us AS event_timestamp, k, article, session_number, entrance, name AS event_name,
    CAST(make_timestamp(us) AS DATE) AS event_date_dt, first_us // 1000000 AS session_id,
    location AS page_location, referrer AS page_referrer,
    CASE WHEN number % 50 <> 49 THEN 'u' || number END AS user_pseudo_id,
    CASE WHEN number % 3 = 0 AND (name = 'subscribe' OR k % 4 <> 0)
      THEN CAST(number AS VARCHAR) END AS user_id,
    CASE WHEN name = 'user_engagement' THEN k * 100 + 50 END AS engagement_time_msec,
    CASE WHEN name = 'user_engagement' THEN 1 END AS session_engaged,
    CASE WHEN name = 'scroll' THEN (k % 4 + 1) * 25 END AS percent_scrolled,
    CASE WHEN name IN ('subscribe', 'newsletter_signup') THEN k * 0.25 END AS event_value_in_usd,
    {', '.join(_slot(n, v) for n, v in _CAMPAIGNS.items())},
    CASE WHEN name IN ('page_view', 'scroll', 'bookmark', 'comment', 'paywall_impression', 'paywall_click',
      'subscribe') THEN article END AS article_param,
    CASE WHEN name = 'share' THEN article END AS item_param,
    CASE WHEN name IN ('paywall_impression', 'paywall_click', 'subscribe') THEN
      CASE article % 2 WHEN 0 THEN 'hard' ELSE 'metered' END END AS paywall_type,
    CASE WHEN name IN ('paywall_impression', 'paywall_click', 'subscribe') THEN
      CASE article % 3 WHEN 0 THEN 'digital-only' WHEN 1 THEN 'basic' ELSE 'premium' END END AS bundle_offer,
    CASE number % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_category,
    CASE number % 4 WHEN 0 THEN 'Windows' WHEN 1 THEN 'Android' WHEN 2 THEN 'iOS' ELSE 'Macintosh' END
      AS device_operating_system,
    'en-us' AS device_language, number % 2 = 0 AS device_is_limited_ad_tracking,
    (number % 5) * 3600 AS device_time_zone_offset_seconds,
    CASE (k + 1) % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Safari' WHEN 2 THEN 'Firefox' ELSE 'Edge' END AS device_browser,
    'www.example.com' AS device_web_info_hostname,
    CASE number % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'United Kingdom' WHEN 2 THEN 'Canada'
      WHEN 3 THEN 'Germany' ELSE 'India' END AS geo_country,
    'region-' || (number % 7) AS geo_region, 'city-' || ((k + 1) % 7) AS geo_city,
    CASE WHEN k = -1 THEN 'launch' END AS user_campaign,
    CASE WHEN k = -1 THEN CASE number % 4 WHEN 0 THEN 'organic' WHEN 1 THEN 'social' WHEN 2 THEN 'email'
      ELSE '(none)' END END AS user_medium,
    CASE WHEN k = -1 THEN CASE number % 4 WHEN 0 THEN 'google' WHEN 1 THEN 'facebook' WHEN 2 THEN 'mailchimp'
      ELSE '(direct)' END END AS user_source,
    'web-1' AS stream_id, 'web' AS platform,
    {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in _NULL_TEXT)}
  FROM all_rows"""
RELATIONS["stg!"] = """
  SELECT f.*, device_browser AS device_web_info_browser, ck AS client_key, sk AS session_key,
    sk || CAST(event_date_dt AS VARCHAR) AS session_partition_key,
    CASE WHEN c AND raw_source IS NULL THEN 'google' ELSE raw_source END AS event_source,
    CASE WHEN c AND (raw_medium IS NULL OR raw_medium = 'organic') THEN 'cpc' ELSE raw_medium END AS event_medium,
    CASE WHEN c AND (raw_campaign IS NULL OR raw_campaign IN ('organic', '(organic)')) THEN '(cpc)'
      ELSE raw_campaign END AS event_campaign,
    raw_content AS event_content, raw_term AS event_term,
    nullif(regexp_extract(page_location, '//[^/]+(/[^?#]*)', 1), '') AS page_path,
    'example.com' AS page_hostname,
    CASE WHEN contains(page_location, '?') THEN substr(page_location, strpos(page_location, '?') + 1) END
      AS page_query_string,
    CAST(event_date_dt AS VARCHAR) || page_location AS page_key,
    CASE event_name WHEN 'share' THEN item_param
      WHEN 'page_view' THEN article_param WHEN 'scroll' THEN article_param WHEN 'bookmark' THEN article_param
      WHEN 'comment' THEN article_param ELSE article END AS article_id
  FROM (SELECT *, md5(user_pseudo_id || stream_id) AS ck,
      md5(md5(user_pseudo_id || stream_id) || CAST(session_id AS VARCHAR)) AS sk,
      page_location LIKE '%gclid%' AS c FROM flat) f"""
RELATIONS["browsing"] = "SELECT * FROM stg WHERE event_name NOT IN ('session_start', 'first_visit')"
RELATIONS["tagged"] = f"""
  SELECT b.*, cat.source_category, {CHANNEL} AS channel
  FROM browsing b LEFT JOIN cat ON b.event_source = cat.source
  WHERE session_partition_key IS NOT NULL AND event_source <> '(direct)'
  QUALIFY row_number() OVER (PARTITION BY session_partition_key ORDER BY {_ORDER}) = 1"""
RELATIONS["m1!"] = f"""
  SELECT s.client_key, s.session_partition_key, s.session_partition_date, s.session_partition_timestamp,
    coalesce(t.event_source, '(direct)') AS session_source, coalesce(t.event_medium, '(none)') AS session_medium,
    coalesce(t.source_category, '(none)') AS session_source_category,
    coalesce(t.event_campaign, '(none)') AS session_campaign, coalesce(t.event_content, '(none)') AS session_content,
    coalesce(t.event_term, '(none)') AS session_term, coalesce(t.channel, 'Direct') AS session_default_channel_grouping,
    t.session_partition_key AS non_direct_session_partition_key
  FROM (SELECT client_key, session_partition_key, event_date_dt AS session_partition_date,
      min(event_timestamp) AS session_partition_timestamp
    FROM browsing WHERE session_partition_key IS NOT NULL GROUP BY ALL) s
  LEFT JOIN tagged t USING (session_partition_key)"""


def _m2(lookback_days: int) -> str:
    attributes = ", ".join(
        f"coalesce(n.session_{f}, '{_DEFAULT.get(f, '(none)')}') AS last_non_direct_{f}" for f in _SOURCE_FIELDS
    )
    return f"""
  SELECT m.*, n.session_partition_key AS session_partition_key_last_non_direct, {attributes}
  FROM (SELECT a.session_partition_key AS own, coalesce(max(a.non_direct_session_partition_key),
      arg_max(b.session_partition_key, (b.session_partition_timestamp, b.session_partition_key))) AS touch
    FROM m1 a LEFT JOIN m1 b ON a.client_key = b.client_key AND b.non_direct_session_partition_key IS NOT NULL
      AND b.session_partition_timestamp BETWEEN a.session_partition_timestamp - {lookback_days} * 86400000000
        AND a.session_partition_timestamp
    GROUP BY a.session_partition_key) x
  JOIN m1 m ON m.session_partition_key = x.own LEFT JOIN m1 n ON n.session_partition_key = x.touch"""


RELATIONS["m2!"] = _m2(LOOKBACK_DAYS)
RELATIONS["m2_month"] = _m2(30)
RELATIONS["m3"] = """
  SELECT session_key, session_partition_key, min(event_date_dt) AS session_partition_date,
    count(*) FILTER (WHERE event_name = 'newsletter_signup') AS newsletter_signup_count
  FROM stg GROUP BY 1, 2"""
_FIRSTS = ", ".join(f"{hit} AS {name}" for name, hit in FIRST_VALUES.items())
RELATIONS["m10!"] = f"""
  SELECT f.*, {", ".join(SESSION_SOURCE + LAST_NON_DIRECT)}
  FROM (SELECT stream_id, session_key, session_partition_key, event_date_dt AS session_partition_date, {_FIRSTS}
    FROM browsing
    QUALIFY row_number() OVER (PARTITION BY stream_id, session_partition_key, event_date_dt ORDER BY {_ORDER}) = 1) f
  LEFT JOIN m2 USING (session_partition_key)"""
RELATIONS["m11!"] = """
  SELECT session_key, client_key, stream_id, max(user_id) AS user_id, session_partition_key,
    min(event_date_dt) AS session_partition_date, min(event_timestamp) AS session_partition_min_timestamp,
    count(*) FILTER (WHERE event_name = 'page_view') AS session_partition_count_page_views,
    sum(event_value_in_usd) AS session_partition_sum_event_value_in_usd,
    coalesce(max(session_engaged), 0) AS session_partition_max_session_engaged,
    sum(engagement_time_msec) AS session_partition_sum_engagement_time_msec,
    min(session_number) AS session_number,
    count(*) FILTER (WHERE event_name = 'newsletter_signup') AS newsletter_signup_count
  FROM stg WHERE session_key IS NOT NULL GROUP BY session_key, client_key, stream_id, session_partition_key"""
RELATIONS["m12"] = """
  SELECT client_key, session_key, stream_id, max(user_id) AS user_id,
    min(session_partition_min_timestamp) AS session_start_timestamp,
    min(session_partition_date) AS session_start_date,
    sum(session_partition_count_page_views) AS count_pageviews,
    sum(session_partition_sum_event_value_in_usd) AS sum_event_value_in_usd,
    max(session_partition_max_session_engaged) AS is_session_engaged,
    sum(session_partition_sum_engagement_time_msec) AS sum_engaged_time_msec,
    min(session_number) AS session_number, sum(newsletter_signup_count) AS count_newsletter_signup
  FROM m11 GROUP BY 1, 2, 3"""
RELATIONS["m13"] = """
  SELECT client_key, stream_id, min(session_start_timestamp) AS first_seen_timestamp,
    min(session_start_date) AS first_seen_start_date, sum(count_pageviews) AS count_pageviews,
    sum(is_session_engaged) AS count_engaged_sessions, sum(sum_event_value_in_usd) AS sum_event_value_in_usd,
    sum(sum_engaged_time_msec) AS sum_engaged_time_msec, count(DISTINCT session_key) AS count_sessions,
    sum(count_newsletter_signup) AS count_newsletter_signup
  FROM m12 GROUP BY 1, 2"""
RELATIONS["m6"] = """
  SELECT user_id AS last_seen_user_id, client_key, last_at AS last_seen_user_id_timestamp
  FROM (SELECT user_id, client_key, max(event_timestamp) AS last_at FROM stg
    WHERE user_id IS NOT NULL AND client_key IS NOT NULL GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY client_key ORDER BY last_at DESC, user_id DESC) = 1"""
RELATIONS["m14"] = """
  SELECT coalesce(last_seen_user_id, client_key) AS user_id_or_client_key, stream_id,
    max(CASE WHEN last_seen_user_id IS NULL THEN 0 ELSE 1 END) AS is_user_id,
    min(first_seen_timestamp) AS first_seen_timestamp, min(first_seen_start_date) AS first_seen_start_date,
    sum(count_pageviews) AS count_pageviews, sum(count_engaged_sessions) AS count_engaged_sessions,
    sum(sum_event_value_in_usd) AS sum_event_value_in_usd, sum(sum_engaged_time_msec) AS sum_engaged_time_msec,
    sum(count_sessions) AS count_sessions, sum(count_newsletter_signup) AS count_newsletter_signup
  FROM m13 LEFT JOIN m6 USING (client_key) GROUP BY 1, 2"""
RELATIONS["properties"] = f"""
  SELECT s.*, CASE WHEN a.user_id IS NOT NULL THEN
      CASE WHEN coalesce({_ACTIVE}, false) THEN 'subscriber' ELSE 'registered' END END AS subscriber_status,
    CASE WHEN coalesce({_ACTIVE}, false) THEN a.subscription_tier END AS subscription_tier
  FROM stg s LEFT JOIN (SELECT user_id, subscription_tier, subscription_date, churn_date FROM acc) a
    ON s.user_id = a.user_id"""
RELATIONS["m7"] = f"""
  SELECT client_key,
    arg_max(subscriber_status, ({_ORDER})) FILTER (WHERE subscriber_status IS NOT NULL) AS subscriber_status,
    arg_max(subscription_tier, ({_ORDER})) FILTER (WHERE subscription_tier IS NOT NULL) AS subscription_tier
  FROM properties WHERE client_key IS NOT NULL GROUP BY 1"""


def _end(prefix: str, direction: str, source: str, columns: list[str]) -> str:
    picked = ", ".join(f"{c} AS {prefix}_{c}" for c in columns)
    order = ", ".join(f"{c} {direction}" for c in _ORDER.split(", "))
    return f"""(SELECT client_key, {picked} FROM {source} WHERE client_key IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY client_key ORDER BY {order}) = 1)"""


RELATIONS["m8"] = f"""
  SELECT * FROM (SELECT client_key, max(stream_id) AS stream_id FROM stg WHERE client_key IS NOT NULL GROUP BY 1)
  JOIN {_end('first', 'ASC', 'stg', ['row_id', *_EVENT_VALUES])} a USING (client_key)
  JOIN {_end('last', 'DESC', 'stg', ['row_id', *_EVENT_VALUES])} b USING (client_key)"""
_VIEW = ["page_location", "page_hostname", "page_referrer"]
RELATIONS["pv"] = "SELECT *, md5(session_key || page_location) AS pek FROM stg WHERE event_name = 'page_view'"
RELATIONS["m9"] = f"""
  SELECT * FROM {_end('first', 'ASC', 'pv', _VIEW)} a JOIN {_end('last', 'DESC', 'pv', _VIEW)} b USING (client_key)"""
RELATIONS["m15"] = "SELECT * FROM m8 LEFT JOIN m9 USING (client_key) LEFT JOIN m7 USING (client_key)"
RELATIONS["m4"] = """
  SELECT page_key, count(*) FILTER (WHERE event_name = 'newsletter_signup') AS newsletter_signup_count
  FROM stg GROUP BY 1"""
RELATIONS["m5"] = """
  SELECT d.pek AS page_engagement_key, t.time / d.views AS page_engagement_time_msec,
    CASE WHEN t.time IS NOT NULL THEN d.views END AS page_engagement_denominator
  FROM (SELECT pek, count(pek) AS views FROM pv GROUP BY 1) d
  LEFT JOIN (SELECT CASE WHEN event_name = 'page_view' THEN md5(session_key || page_referrer)
      ELSE md5(session_key || page_location) END AS pek, sum(engagement_time_msec) AS time
    FROM stg GROUP BY 1) t ON d.pek = t.pek"""
RELATIONS["m16!"] = """
  SELECT p.*, coalesce(c.newsletter_signup_count, 0) AS newsletter_signup_count,
    coalesce(s.scroll_events, 0) AS scroll_events
  FROM (SELECT event_date_dt, stream_id, page_location, page_key, sum(page_views) AS page_views,
      sum(distinct_client_keys) AS distinct_client_keys, sum(new_client_keys) AS new_client_keys,
      sum(entrances) AS entrances, sum(page_engagement_time_msec) AS total_engagement_time_msec,
      sum(page_engagement_denominator) AS avg_engagement_time_denominator
    FROM (SELECT event_date_dt, stream_id, page_location, page_key, pek, count(*) AS page_views,
        count(DISTINCT client_key) AS distinct_client_keys, count(*) FILTER (WHERE session_number = 1) AS new_client_keys,
        count(*) FILTER (WHERE entrance) AS entrances FROM pv GROUP BY ALL) v
    LEFT JOIN m5 ON v.pek = m5.page_engagement_key GROUP BY 1, 2, 3, 4) p
  LEFT JOIN m4 c ON p.page_key = c.page_key
  LEFT JOIN (SELECT event_date_dt, page_location, count(*) AS scroll_events FROM stg WHERE event_name = 'scroll'
    GROUP BY 1, 2) s ON p.event_date_dt = s.event_date_dt AND p.page_location = s.page_location"""
RELATIONS["reads"] = """
  SELECT * FROM stg WHERE article_id IS NOT NULL AND event_name IN ('page_view', 'scroll', 'share', 'bookmark',
    'comment', 'newsletter_signup', 'user_engagement', 'video_start', 'video_complete')"""
RELATIONS["m17!"] = f"""
  SELECT d.*, art.* EXCLUDE (article_id) FROM (SELECT event_date_dt, article_id, {_METRIC_SUMS}
    FROM reads GROUP BY 1, 2) d JOIN art ON d.article_id = art.article_id"""
RELATIONS["classified"] = f"""
  SELECT r.*, CASE WHEN a.user_id IS NULL THEN 'anonymous' WHEN coalesce({_ACTIVE}, false) THEN 'subscriber'
      ELSE 'registered' END AS reader_type,
    CASE WHEN coalesce({_ACTIVE}, false) THEN coalesce(a.subscription_tier, 'unknown') ELSE 'n/a' END
      AS subscription_tier
  FROM reads r LEFT JOIN (SELECT user_id, subscription_tier, subscription_date, churn_date FROM acc) a
    ON r.user_id = a.user_id"""
RELATIONS["m18!"] = f"""
  SELECT d.*, art.* EXCLUDE (article_id)
  FROM (SELECT event_date_dt, article_id, reader_type, subscription_tier, {_METRIC_SUMS}
    FROM classified GROUP BY 1, 2, 3, 4) d JOIN art ON d.article_id = art.article_id"""
RELATIONS["walls"] = "SELECT * FROM stg WHERE event_name IN ('paywall_impression', 'paywall_click')"
_WALL_COUNTS = """
    count(*) FILTER (WHERE event_name = 'paywall_impression') AS paywall_impressions,
    count(*) FILTER (WHERE event_name = 'paywall_click') AS paywall_clicks"""
RELATIONS["m19"] = f"""
  SELECT event_date_dt, article_param AS article_id, paywall_type, bundle_offer, {_WALL_COUNTS}
  FROM walls GROUP BY 1, 2, 3, 4"""
RELATIONS["m20"] = f"""
  SELECT event_date_dt, session_partition_key, {_WALL_COUNTS} FROM walls
  WHERE session_partition_key IS NOT NULL GROUP BY 1, 2 HAVING paywall_impressions > 0"""
RELATIONS["visits!"] = """
  SELECT d.*, f.client_key, f.session_partition_count_page_views AS page_view_count,
    CASE WHEN f.session_partition_max_session_engaged > 0 THEN 1 ELSE 0 END AS session_engaged_flag,
    f.session_partition_sum_engagement_time_msec AS engagement_time_msec, f.newsletter_signup_count
  FROM m10 d JOIN m11 f ON d.session_partition_key = f.session_partition_key"""
RELATIONS["m21"] = """
  SELECT session_partition_date, session_default_channel_grouping, session_source, session_medium,
    last_non_direct_source, last_non_direct_medium, last_non_direct_default_channel_grouping,
    count(DISTINCT session_partition_key) AS sessions, sum(page_view_count) AS page_views,
    sum(session_engaged_flag) AS engaged_sessions, sum(newsletter_signup_count) AS newsletter_signups,
    sum(engagement_time_msec) AS engagement_time_msec
  FROM visits GROUP BY 1, 2, 3, 4, 5, 6, 7"""

RELATIONS["subs"] = """
  SELECT user_id, user_pseudo_id, subscription_date, subscription_tier, churn_date FROM acc
  WHERE subscription_date IS NOT NULL"""
RELATIONS["buys"] = f"""
  SELECT user_id, session_partition_key, event_timestamp AS subscription_ts, article_param AS paywall_article_id
  FROM stg WHERE event_name = 'subscribe' AND user_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {_ORDER}) = 1"""
RELATIONS["history"] = """
  SELECT s.user_id AS subscriber, s.subscription_date, e.* FROM stg e
  JOIN subs s ON e.user_pseudo_id = s.user_pseudo_id WHERE e.event_date_dt <= s.subscription_date"""
_PLACE = "platform device_category device_operating_system device_browser geo_country geo_region geo_city".split()
RELATIONS["purchases"] = f"""
  SELECT subscriber AS user_id, session_partition_key AS purchase_session_key,
    event_date_dt AS purchase_session_date, event_timestamp AS purchase_session_ts, {", ".join(_PLACE)}
  FROM (SELECT h.* FROM history h JOIN buys b ON h.subscriber = b.user_id
      AND h.session_partition_key = b.session_partition_key WHERE event_name = 'session_start'
    UNION ALL SELECT h.* FROM history h WHERE event_name = 'session_start'
      AND NOT EXISTS (SELECT 1 FROM buys b WHERE b.user_id = h.subscriber))
  QUALIFY row_number() OVER (PARTITION BY subscriber ORDER BY event_timestamp DESC, session_partition_key DESC) = 1"""
RELATIONS["last_reads"] = """
  SELECT subscriber AS user_id, article_id AS last_article_id, event_timestamp AS last_read_ts,
    CASE WHEN user_id IS NOT NULL THEN 'registered' ELSE 'anonymous' END AS last_article_reader_state
  FROM (SELECT h.* FROM history h JOIN buys b ON h.subscriber = b.user_id WHERE event_name = 'page_view'
      AND event_timestamp < subscription_ts AND event_timestamp >= subscription_ts - 604800000000
    UNION ALL SELECT h.* FROM history h WHERE event_name = 'page_view'
      AND event_date_dt BETWEEN subscription_date - 7 AND subscription_date
      AND NOT EXISTS (SELECT 1 FROM buys b WHERE b.user_id = h.subscriber))
  QUALIFY row_number() OVER (PARTITION BY subscriber
    ORDER BY event_timestamp DESC, session_partition_key DESC, article_id DESC) = 1"""
RELATIONS["first_walls"] = """
  SELECT subscriber AS user_id, session_partition_key AS first_wall_session_key, event_timestamp AS first_wall_ts
  FROM history WHERE event_name = 'paywall_impression'
  QUALIFY row_number() OVER (PARTITION BY subscriber ORDER BY event_timestamp, session_partition_key) = 1"""
RELATIONS["prior_walls"] = """
  SELECT h.subscriber AS user_id,
    count(*) FILTER (WHERE h.event_timestamp < p.purchase_session_ts) AS prior_wall_impressions
  FROM history h JOIN purchases p ON h.subscriber = p.user_id WHERE h.event_name = 'paywall_impression' GROUP BY 1"""
RELATIONS["sub_rows!"] = f"""
  SELECT s.user_id, s.subscription_tier, s.subscription_date, s.churn_date,
    CASE WHEN b.user_id IS NOT NULL THEN 'subscribe_event' ELSE 'crm_only' END AS subscription_source,
    b.subscription_ts, b.paywall_article_id, w.title AS paywall_article_title, p.purchase_session_key,
    p.purchase_session_date, p.purchase_session_ts,
    p.purchase_session_date = s.subscription_date AS purchased_same_day, fw.first_wall_session_key,
    pw.prior_wall_impressions,
    date_diff('day', CAST(make_timestamp(fw.first_wall_ts) AS DATE), s.subscription_date) AS days_first_wall_to_sub,
    {", ".join("p." + c for c in _PLACE)}, t.session_source, t.session_medium, t.session_campaign,
    t.session_default_channel_grouping, l.last_article_id, a.title AS last_article_title,
    a.section AS last_article_section, l.last_read_ts, l.last_article_reader_state,
    date_diff('day', CAST(make_timestamp(l.last_read_ts) AS DATE), s.subscription_date)
      AS days_last_read_before_subscription,
    p.purchase_session_key = fw.first_wall_session_key AS converted_on_first_wall_session
  FROM subs s LEFT JOIN buys b ON b.user_id = s.user_id LEFT JOIN purchases p ON p.user_id = s.user_id
  LEFT JOIN m1 t ON t.session_partition_key = p.purchase_session_key
  LEFT JOIN last_reads l ON l.user_id = s.user_id LEFT JOIN art a ON a.article_id = l.last_article_id
  LEFT JOIN art w ON w.article_id = b.paywall_article_id
  LEFT JOIN prior_walls pw ON pw.user_id = s.user_id LEFT JOIN first_walls fw ON fw.user_id = s.user_id"""
RELATIONS["medians"] = """
  SELECT quantile_cont(prior_wall_impressions, 0.5) AS median_prior_wall_impressions,
    quantile_cont(days_first_wall_to_sub, 0.5) AS median_days_first_wall_to_sub FROM sub_rows"""
RELATIONS["m22"] = "SELECT * FROM sub_rows CROSS JOIN medians"
RELATIONS["m23"] = f"""
  SELECT r.row_id, r.client_key, r.event_date_dt, r.event_timestamp, r.article_id, art.section, r.read_of_month,
    CASE WHEN coalesce({_ACTIVE}, false) THEN 'free' WHEN section = 'politics' THEN 'hard'
      WHEN section IN ('sports', 'culture') AND read_of_month > 3 THEN 'metered' ELSE 'free' END AS wall
  FROM (SELECT *, row_number() OVER (PARTITION BY client_key, date_trunc('month', event_date_dt) ORDER BY {_ORDER})
      AS read_of_month FROM pv WHERE client_key IS NOT NULL) r
  LEFT JOIN art ON art.article_id = r.article_id
  LEFT JOIN (SELECT user_id, subscription_date, churn_date FROM acc) a ON a.user_id = r.user_id"""
RELATIONS["days"] = """
  SELECT CAST(unnest(generate_series(min(event_date_dt), max(event_date_dt), INTERVAL 1 DAY)) AS DATE) AS as_of_date
  FROM stg"""
RELATIONS["crm_totals"] = """
  SELECT as_of_date, (SELECT count(*) FROM acc WHERE registration_date <= as_of_date) AS registered_total,
    (SELECT count(*) FROM acc WHERE subscription_date <= as_of_date) AS subscriber_starts_total,
    (SELECT count(*) FROM acc WHERE churn_date <= as_of_date) AS churned_total,
    (SELECT count(*) FROM acc WHERE subscription_date <= as_of_date)
      - (SELECT count(*) FROM acc WHERE churn_date <= as_of_date) AS active_subscribers_total
  FROM days"""
RELATIONS["content_totals"] = """
  SELECT as_of_date, (SELECT count(*) FROM art WHERE published_at <= CAST(as_of_date AS TIMESTAMP)) AS articles_total
  FROM days"""
RELATIONS["funnel"] = """
  SELECT event_date_dt AS event_date, count(*) AS sessions_exposed, sum(paywall_impressions) AS impressions,
    sum(paywall_clicks) AS clicks,
    (SELECT count(*) FROM sub_rows s WHERE s.subscription_date = m20.event_date_dt) AS new_subscribers
  FROM m20 GROUP BY event_date_dt"""
RELATIONS["event_state"] = f"""
  SELECT s.event_date_dt AS event_date, event_name, client_key, s.user_id, page_location, a.user_id AS account,
    coalesce({_ACTIVE}, false) AS active
  FROM stg s LEFT JOIN (SELECT user_id, subscription_date, churn_date FROM acc) a ON s.user_id = a.user_id"""

_ALL = ",\n".join(
    f"{name.rstrip('!')} AS {'MATERIALIZED ' if name.endswith('!') else ''}({body})" for name, body in RELATIONS.items()
)


def over_relations(select: str) -> str:
    """A full query: the shared relations followed by ``select``."""
    return f"WITH {_ALL}\n{select}"
