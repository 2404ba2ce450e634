from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from inkwell.plans import articles
from tests.rows import DAY, SECOND, account, article, hit, micros, warehouse

START = micros("2024-01-01T12:00:00")
PAGE = "https://a.b/news/article-1"


def view(at, session=1, page=PAGE, **values):
    return hit("page_view", at, session=session, page_location=page, **values)


def test_engaged_time_is_an_average_per_session_and_page(spark, tmp_path):
    hits = [
        view(START, entrances=1),
        view(START + 1),
        hit("user_engagement", START + 2, page_location=PAGE, engagement_time_msec=30),
        # Time on a page view belongs to the page before it.
        view(START + 3, page="https://a.b/next", page_referrer=PAGE, engagement_time_msec=15),
        hit("scroll", START + 4, page_location=PAGE),
        hit("newsletter_signup", START + 5, page_location=PAGE),
        # Another session of the same page without any time.
        view(START + 6, session=2),
    ]
    w = warehouse(spark, tmp_path, hits)
    time = {r.page_engagement_denominator: r.page_engagement_time_msec for r in w.relation("page_engaged_time").collect()}
    assert time == {2: 22.5, None: None}
    (page,) = w.relation("pages").filter(F.col("page_location") == PAGE).collect()
    assert (page.page_views, page.distinct_client_keys, page.new_client_keys, page.entrances) == (3, 2, 3, 1)
    assert (page.total_engagement_time_msec, page.avg_engagement_time_denominator) == (22.5, 2)
    assert (page.scroll_events, page.newsletter_signup_count) == (1, 1)
    (other,) = w.relation("pages").filter(F.col("page_location") != PAGE).collect()
    assert other.total_engagement_time_msec is None and other.scroll_events == 0


def test_engaged_time_of_a_session_over_midnight_counts_on_both_days(spark, tmp_path):
    late = micros("2024-01-01T23:59:59")
    hits = [
        view(late),
        view(late + 2 * SECOND),
        hit("user_engagement", late, page_location=PAGE, engagement_time_msec=10),
    ]
    rows = warehouse(spark, tmp_path, hits).relation("pages").collect()
    assert [r.total_engagement_time_msec for r in rows] == [5.0, 5.0]


def test_page_views_without_client_count(spark, tmp_path):
    w = warehouse(spark, tmp_path, [view(START, client=None), view(START + 1)])
    (page,) = w.relation("pages").collect()
    assert (page.page_views, page.distinct_client_keys) == (2, 1)


def test_articles_are_found_by_parameter_or_url(spark, tmp_path):
    hits = [
        view(START, article_id="1", entrances=1),
        view(START + 1, client="c2", article_id="1"),
        hit("share", START + 2, item_id="1", article_id="2"),
        hit("scroll", START + 3, article_id="1", percent_scrolled=50),
        hit("scroll", START + 4, article_id="1", percent_scrolled=25),
        hit("user_engagement", START + 5, page_location=PAGE, engagement_time_msec=40),
        hit("video_start", START + 6, page_location=PAGE),
        # Not a number, not known, no article at all, no article event.
        view(START + 7, article_id="abc"),
        view(START + 8, article_id="99"),
        view(START + 9, page="https://a.b/"),
        hit("search", START + 10, article_id="1"),
    ]
    w = warehouse(spark, tmp_path, hits, [article(1), article(2)])
    (row,) = w.relation("articles_daily").collect()
    assert (row.article_id, row.title, row.page_views, row.distinct_client_keys) == (1, "T1", 2, 2)
    assert (row.share_events, row.scroll_events, row.avg_scroll_percent, row.entrances) == (1, 2, 37.5, 1)
    assert (row.engagement_time_msec, row.video_starts, row.video_completes) == (40, 1, 0)


def test_reader_types_follow_the_subscription(spark, tmp_path):
    people = [
        account("u", subscription_date=dt.date(2024, 1, 2), churn_date=dt.date(2024, 1, 3), subscription_tier="basic"),
    ]
    hits = [view(START + i * DAY, user_id="u", article_id="1") for i in range(3)]
    hits += [view(START, user_id="unknown", article_id="1", client="x"), view(START, article_id="1", client="y")]
    rows = warehouse(spark, tmp_path, hits, [article(1)], people).relation("articles_by_reader_type").collect()
    seen = sorted((str(r.event_date_dt), r.reader_type, r.subscription_tier, r.page_views) for r in rows)
    assert seen == [
        ("2024-01-01", "anonymous", "n/a", 2),
        ("2024-01-01", "registered", "n/a", 1),
        ("2024-01-02", "subscriber", "basic", 1),
        ("2024-01-03", "registered", "n/a", 1),
    ]


def test_paywall_marts(spark, tmp_path):
    def wall(name, at, **values):
        return hit(name, at, article_id="1", paywall_type="hard", bundle_offer="basic", **values)

    hits = [
        wall("paywall_impression", START),
        wall("paywall_impression", START + 1, session=2),
        wall("paywall_click", START + 2),
        wall("paywall_click", START + 3, session=3),
        wall("paywall_impression", START + 4, client=None),
        hit("paywall_impression", START + 5, session=4),
    ]
    w = warehouse(spark, tmp_path, hits)
    (daily,) = w.relation("paywall_daily").collect()
    assert (daily.article_id, daily.paywall_impressions, daily.paywall_clicks) == (1, 3, 2)
    exposed = w.relation("paywall_sessions_daily").collect()
    # Clicks alone do not expose a session, and hits without a session are left out.
    assert sorted((r.paywall_impressions, r.paywall_clicks) for r in exposed) == [(1, 0), (1, 0), (1, 1)]


def test_wall_policy_counts_reads_of_the_month(spark, tmp_path):
    people = [account("s", subscription_date=dt.date(2024, 1, 1), subscription_tier="basic")]
    sections = {1: "politics", 2: "sports", 3: "lifestyle"}
    cms = [article(n, section=s) for n, s in sections.items()]
    january = micros("2024-01-30T10:00:00")
    reads = [(0, "2"), (1, "2"), (2, "1"), (3, "2"), (4, "3"), (5, "x"), (DAY, "2"), (2 * DAY, "2")]
    hits = [view(january + offset, article_id=number) for offset, number in reads]
    hits += [view(january + i, client="s", user_id="s", article_id="1") for i in range(2)]
    w = warehouse(spark, tmp_path, hits, cms, people)
    walls = {"politics": "hard", "sports": "metered", "lifestyle": "free"}
    rows = articles.wall_policy(w.event_type("page_view"), w.table("articles"), w.table("accounts"), walls)
    known = w.table("staged_events").filter("user_id is null").first().client_key
    mine = rows.filter(F.col("client_key") == known).orderBy("event_timestamp").collect()
    assert [(r.read_of_month, r.wall) for r in mine] == [
        (1, "free"),
        (2, "free"),
        (3, "hard"),
        (4, "metered"),
        (5, "free"),
        (6, "metered"),
        (1, "free"),
    ]
    assert {r.wall for r in rows.filter(F.col("client_key") != known).collect()} == {"free"}


def test_client_relations(spark, tmp_path):
    hits = [
        view(START, geo={"city": "first"}, properties={"subscriber_status": "registered"}),
        hit("scroll", START + 1, user_id="u1", properties={"subscriber_status": "subscriber", "subscription_tier": "basic"}),
        view(START + 2, page="https://a.b/z", user_id="u2", properties={"subscriber_status": "registered"}),
        hit("scroll", START + 3, geo={"city": "last"}, session=2),
        view(START, client="c2"),
        hit("scroll", START, client=None, user_id="u1"),
    ]
    w = warehouse(spark, tmp_path, hits)
    dims = {r.first_geo_city: r for r in w.relation("client_dimension").collect()}
    row = dims["first"]
    assert len(dims) == 2 and row.last_geo_city == "last"
    assert (row.first_page_location, row.last_page_location) == (PAGE, "https://a.b/z")
    # The newest value that is not null, property by property.
    assert (row.subscriber_status, row.subscription_tier) == ("registered", "basic")
    (mapped,) = w.relation("user_id_mapping").collect()
    assert (mapped.last_seen_user_id, mapped.last_seen_user_id_timestamp) == ("u2", START + 2)
    users = {r.is_user_id: r for r in w.relation("user_facts").collect()}
    assert users[1].user_id_or_client_key == "u2" and users[1].count_sessions == 2
    assert users[1].count_pageviews == 2 and users[0].count_pageviews == 1


def subscriptions(spark, tmp_path, hits, people, cms=(article(1), article(2))):
    rows = warehouse(spark, tmp_path, hits, cms, people).relation("subscription_last_touch").collect()
    return {r.user_id: r for r in rows}


def subscriber(user, day=10, **values):
    return account(
        user, subscription_date=dt.date(2024, 1, day), subscription_tier="basic", **{"user_pseudo_id": user} | values
    )


def test_subscription_by_event(spark, tmp_path):
    buy = micros("2024-01-10T12:00:00")
    geo, device = {"country": "US"}, {"category": "mobile"}
    hits = [
        hit("session_start", buy - 5 * DAY, client="u", session=1),
        hit("paywall_impression", buy - 5 * DAY + 1, client="u", session=1),
        hit("paywall_impression", buy - 5 * DAY + 2, client="u", session=1),
        view(buy - 5 * DAY + 3, client="u", article_id="2", source="google", medium="organic"),
        hit("session_start", buy - 10, client="u", session=2, geo=geo, device=device),
        hit("paywall_impression", buy - 5, client="u", session=2),
        view(buy - 4, client="u", session=2, article_id="1", user_id="u", source="bing", medium="organic"),
        hit("subscribe", buy, client="u", session=2, user_id="u", article_id="1"),
        # Later on the day: no read, no prior wall, but still history.
        view(buy + 1, client="u", session=2, article_id="2"),
        # A later session of the same day does not become the purchase session.
        hit("session_start", buy + 5, client="u", session=3),
        # A second subscribe event does not add a row.
        hit("subscribe", buy + 9, client="u", session=3, user_id="u", article_id="2"),
    ]
    row = subscriptions(spark, tmp_path, hits, [subscriber("u")])["u"]
    assert (row.subscription_source, row.paywall_article_id, row.paywall_article_title) == ("subscribe_event", 1, "T1")
    assert (row.geo_country, row.device_category, row.session_source) == ("US", "mobile", "bing")
    assert row.purchased_same_day is True and row.converted_on_first_wall_session is False
    assert (row.prior_wall_impressions, row.days_first_wall_to_sub) == (2, 5)
    assert (row.last_article_id, row.last_article_reader_state) == (1, "registered")
    assert row.days_last_read_before_subscription == 0
    assert (row.median_prior_wall_impressions, row.median_days_first_wall_to_sub) == (2.0, 5.0)


def test_last_read_lies_within_a_week(spark, tmp_path):
    buy = micros("2024-01-10T12:00:00")
    base = [hit("subscribe", buy, client="u", user_id="u"), hit("session_start", buy - 1, client="u")]
    inside = view(buy - 7 * DAY, client="u", article_id="1")
    outside = view(buy - 7 * DAY - 1, client="u", article_id="2")
    rows = subscriptions(spark, tmp_path / "a", [*base, inside, outside], [subscriber("u")])
    assert rows["u"].last_article_id == 1
    rows = subscriptions(spark, tmp_path / "b", [*base, outside], [subscriber("u")])
    assert rows["u"].last_article_id is None and rows["u"].prior_wall_impressions is None


def test_subscription_by_account_only(spark, tmp_path):
    day = micros("2024-01-10T09:00:00")
    hits = [
        hit("session_start", day - DAY, client="u", session=1),
        hit("paywall_impression", day - DAY + 1, client="u", session=1),
        hit("session_start", day + 1, client="u", session=2),
        view(day + 2, client="u", session=2, page=PAGE),
        # After the day of the subscription.
        hit("session_start", day + DAY, client="u", session=3),
        view(day + DAY, client="u", session=3, article_id="2"),
    ]
    rows = subscriptions(spark, tmp_path, hits, [subscriber("u"), subscriber("v"), account("w")])
    assert sorted(rows) == ["u", "v"]
    row = rows["u"]
    assert (row.subscription_source, row.subscription_timestamp) == ("crm_only", None)
    assert str(row.purchase_session_date) == "2024-01-10" and row.purchased_same_day is True
    assert (row.last_article_id, row.last_article_reader_state, row.prior_wall_impressions) == (1, "anonymous", 1)
    assert rows["v"].purchase_session_key is None and rows["v"].converted_on_first_wall_session is None


def test_purchase_session_over_midnight_is_lost_without_fallback(spark, tmp_path):
    late = micros("2024-01-09T23:59:59")
    hits = [
        hit("session_start", late, client="u"),
        hit("subscribe", late + 2 * SECOND, client="u", user_id="u"),
    ]
    row = subscriptions(spark, tmp_path, hits, [subscriber("u")])["u"]
    assert row.subscription_source == "subscribe_event" and row.purchase_session_key is None


def test_medians_ignore_missing_journeys(spark, tmp_path):
    day = micros("2024-01-10T09:00:00")
    hits, people = [], []
    for n, days in enumerate((1, 2, 7, 8)):
        user = f"u{n}"
        people.append(subscriber(user))
        hits.append(hit("paywall_impression", day - days * DAY, client=user))
    rows = subscriptions(spark, tmp_path, hits, [*people, subscriber("none")])
    assert rows["none"].median_days_first_wall_to_sub == 4.5
    assert rows["u0"].median_prior_wall_impressions is None
