from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from inkwell.plans import metrics, quality
from inkwell.plans.cubes import CUBES
from inkwell.plans.dashboards import NAMED_QUERIES, named_query
from inkwell.plans.metrics import DateRange, MetricQuery, grain_for, metric_query
from tests.rows import DAY, account, article, hit, micros, warehouse
from tests.test_plans import plan

START = micros("2024-01-03T12:00:00")
RANGE = DateRange.of("2024-01-01", "2024-01-31")


@pytest.fixture(scope="module")
def w(spark, tmp_path_factory):
    day = dt.date
    people = [
        account("a", subscription_date=day(2024, 1, 4), churn_date=day(2024, 1, 6), subscription_tier="basic"),
        account("b", subscription_date=day(2024, 1, 5), subscription_tier="premium"),
        account("c", registration_date=day(2024, 1, 5)),
    ]
    cms = [
        article(1, published_at=dt.datetime(2024, 1, 4)),
        article(2, published_at=dt.datetime(2024, 1, 4, 8), section=None),
    ]
    page = "https://a.b/news/article-1"
    hits = [
        hit("page_view", START, page_location=page, article_id="1", user_id="a", engagement_time_msec=500),
        hit("page_view", START + DAY, session=2, page_location=page, article_id="2", user_id="a"),
        hit("paywall_impression", START + DAY, session=2, article_id="1", paywall_type="hard"),
        hit("paywall_click", START + DAY + 1, session=2, article_id="1", paywall_type="hard"),
        hit("page_view", START + 2 * DAY, client="c2", session=3, page_location=page, user_id="x"),
        hit("scroll", START + 3 * DAY, client="c2", session=4, user_id="a"),
        hit("scroll", START + 3 * DAY, client=None),
    ]
    return warehouse(spark, tmp_path_factory.mktemp("w"), hits, cms, people)


def first(df):
    return df.first().asDict()


def test_grain_follows_the_range():
    assert grain_for(DateRange.of("2024-01-01", "2024-02-01")) == "day"
    assert grain_for(DateRange.of("2024-01-01", "2024-02-02")) == "week"
    assert grain_for(DateRange.of("2024-01-01", "2024-04-30")) == "week"
    assert grain_for(DateRange.of("2024-01-01", "2024-05-01")) == "month"


def test_catalog_is_complete():
    # One measure more than the catalog: registered logins.
    assert len(CUBES) == 14
    assert sum(len(c.measures) for c in CUBES.values()) == 66 + 1
    assert sum(len(c.dimensions) for c in CUBES.values()) == 83
    assert len(NAMED_QUERIES) == 39


def test_ratios_are_fractions(w):
    query = MetricQuery(["sessions.sessions", "sessions.activeUsers", "sessions.sessionsPerUser"])
    assert first(metric_query(w, query)) == {"sessions": 4, "activeUsers": 2, "sessionsPerUser": 2.0}
    empty = MetricQuery(["paywall.ctr", "paywall.clicks"], time_dimension="paywall.eventDate")
    assert first(metric_query(w, empty, DateRange.of("2023-01-01", "2023-01-02"))) == {"ctr": None, "clicks": None}


def test_range_ends_are_included(w):
    query = MetricQuery(["events.eventsCount"], time_dimension="events.eventDate")
    assert first(metric_query(w, query, DateRange.of("2024-01-03", "2024-01-04")))["eventsCount"] == 4
    published = MetricQuery(["content.articlesPublished"], time_dimension="content.publicationDate")
    assert first(metric_query(w, published, DateRange.of("2024-01-04", "2024-01-04")))["articlesPublished"] == 2


def test_active_readers(w):
    members = ["activeUsers", "activeRegisteredUsers", "activeAccounts", "activeSubscribers"]
    found = first(metric_query(w, MetricQuery([f"events.{m}" for m in members])))
    assert found == {"activeUsers": 2, "activeRegisteredUsers": 2, "activeAccounts": 1, "activeSubscribers": 1}


def test_totals_as_of_a_day(w):
    totals = {str(r.as_of_date): r for r in CUBES["crmTotals"].relation(w).collect()}
    assert [totals[f"2024-01-0{d}"].active_subscribers_total for d in (3, 4, 5, 6)] == [0, 1, 2, 1]
    assert [totals[f"2024-01-0{d}"].registered_total for d in (4, 5)] == [2, 3]
    query = MetricQuery(["crmTotals.numberOfSubscribers", "crmTotals.cumulativeSubscribers"])
    assert first(metric_query(w, query)) == {"numberOfSubscribers": 1, "cumulativeSubscribers": 2}
    # The article of 8 o'clock counts from the next day on.
    inventory = {str(r.as_of_date): r.articles_total for r in CUBES["contentTotals"].relation(w).collect()}
    assert [inventory[f"2024-01-0{d}"] for d in (3, 4, 5)] == [0, 1, 2]


def test_funnel_counts_subscribers_of_exposed_days_only(w):
    (day,) = CUBES["paywallFunnel"].relation(w).collect()
    assert (str(day.event_date), day.sessions_exposed, day.new_subscribers) == ("2024-01-04", 1, 1)
    steps = metrics.wall_funnel(w, RANGE).orderBy("step").collect()
    assert [(s.label, s.value, s.share) for s in steps] == [
        ("impressions", 1, 1.0),
        ("clicks", 1, 1.0),
        ("subscribers", 1, 1.0),
    ]
    nothing = metrics.wall_funnel(w, DateRange.of("2023-01-01", "2023-01-02")).collect()
    assert [(s.value, s.share) for s in nothing] == [(0, 0.0)] * 3


def test_shapes(w):
    by_section = MetricQuery(["articles.articlePageviews"], ["articles.section"])
    rows = metrics.breakdown(w, by_section, "articles.section", "articles.articlePageviews", RANGE).collect()
    assert [(r.name, r.value) for r in rows] == [("politics", 1), ("—", 1)]
    series = {
        "crm.newSubscribers": ("New", "crm.subscriptionDate"),
        "crm.newChurns": ("Churned", "crm.churnDate"),
    }
    parts = [
        metrics.trend(w, MetricQuery([m], time_dimension=day, grain="day"), {m: name}, RANGE)
        for m, (name, day) in series.items()
    ]
    merged = metrics.merge_trends(parts).collect()
    assert [(str(r.date), r.New, r.Churned) for r in merged] == [
        ("2024-01-04", 1, 0),
        ("2024-01-05", 1, 0),
        ("2024-01-06", 0, 1),
    ]
    assert first(metrics.net_new_subscribers(w, RANGE)) == {"newSubscribers": 2, "newChurns": 1, "netNew": 1}


def test_change_needs_a_previous_value(w):
    query = MetricQuery(["events.eventsCount"], time_dimension="events.eventDate")
    now, before = DateRange.of("2024-01-04", "2024-01-04"), DateRange.of("2024-01-03", "2024-01-03")
    assert first(metrics.period_change(w, query, now, before))["eventsCount_change"] == 2.0
    empty = DateRange.of("2023-01-01", "2023-01-02")
    assert first(metrics.period_change(w, query, now, empty))["eventsCount_change"] is None


def test_members_of_two_cubes_are_refused(w):
    with pytest.raises(ValueError, match="one cube"):
        metric_query(w, MetricQuery(["crm.newChurns"], ["traffic.channelGrouping"]))


def test_top_articles_are_limited_and_ordered(w):
    rows = named_query(w, "content.topArticlesQ", RANGE).collect()
    assert [(r.title, r.articlePageviews) for r in rows] == [("T1", 1), ("T2", 1)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "a"), (None, "a")], "k int, v string")
    assert first(quality.not_null(df, "v"))["failures"] == 1
    assert first(quality.not_null(df, "v", level="warn"))["passed"] is True
    assert first(quality.unique(df, F.col("k"), "k"))["failures"] == 1
    assert first(quality.unique(df, F.col("k"), "k", where=F.col("v") == "b"))["passed"] is True
    assert first(quality.unique_combination(df, ["k", "v"]))["failures"] == 1
    assert first(quality.accepted_values(df, "v", ["a"]))["failures"] == 1
    totals = df.agg(F.count("*").alias("n"), F.sum("k").alias("s"))
    checks = quality.control_totals(totals, {"n": 5, "s": 3}).collect()
    assert [c.passed for c in checks] == [True, False]
    left, right = df.agg(F.count("*")), df.agg(F.count("k"))
    gap = df.agg(F.count_if(F.col("k").isNull()))
    assert first(quality.reconciliation("x", left, right))["passed"] is False
    assert first(quality.reconciliation("x", left, right, gap))["passed"] is True


def test_routes_to_the_same_total(w):
    pages = metric_query(w, MetricQuery(["pages.pageviews"]))
    visits = metric_query(w, MetricQuery(["sessions.pageviews"]))
    assert first(quality.reconciliation("views", pages, visits))["passed"] is True
    traffic = metric_query(w, MetricQuery(["traffic.sessions"]))
    sessions = metric_query(w, MetricQuery(["sessions.sessions"]))
    assert first(quality.reconciliation("sessions", traffic, sessions))["passed"] is True


def test_active_clients_and_logins_come_from_bitmaps(spark, tmp_path):
    start = micros("2024-01-01T12:00:00")
    hits = [
        hit("page_view", start + n * DAY, client=f"c{(n * k) % 7}", session=n, user_id=f"u{k}" if k % 2 else None)
        for n in range(12) for k in range(4)
    ]
    hits += [hit("page_view", start + 3 * DAY, client=None, session=None)]
    # Ids keep their numbers over runs, also when ids come in between.
    for last in (6, 8, 11):
        w = warehouse(spark, tmp_path, [h for h in hits if h["event_timestamp"] <= start + last * DAY])
        w.build(dt.date(2024, 1, 1 + last))
    numbers = w.table("id_numbers")
    assert numbers.count() == numbers.select("kind", "number").distinct().count() == numbers.select("kind", "id").distinct().count()
    staged = w.table("staged_events")
    for first, until in (("2024-01-02", "2024-01-05"), ("2024-01-01", "2024-01-12"), ("2025-01-01", "2025-01-02")):
        range_ = DateRange.of(first, until)
        in_range = staged.where(range_.covers(F.col("event_date_dt")))
        (wanted,) = in_range.agg(F.countDistinct("client_key"), F.countDistinct("user_id"), F.count("*")).collect()
        query = MetricQuery(["events.activeUsers", "events.activeRegisteredUsers", "events.eventsCount"], time_dimension="events.eventDate")
        assert tuple(metric_query(w, query, range_).first()) == tuple(wanted)
        weekly = dataclasses.replace(query, grain="week")
        found = {r.eventDate: tuple(r)[1:] for r in metric_query(w, weekly, range_).collect()}
        by_week = in_range.groupBy(F.date_trunc("week", "event_date_dt").cast("date").alias("d")).agg(
            F.countDistinct("client_key"), F.countDistinct("user_id"), F.count("*")
        )
        assert found == {r.d: tuple(r)[1:] for r in by_week.collect()}
    only = MetricQuery(["sessions.activeUsers"], time_dimension="sessions.eventDate")
    text = plan(metric_query(w, only, DateRange.of("2024-01-01", "2024-01-12")))
    assert "activity_bitmaps" in text and "client_key" not in text and "session_activity" not in text
