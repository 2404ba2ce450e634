from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from inkwell.functions import channels, urls
from inkwell.functions.params import column_name, param, session_engaged, session_id
from inkwell.functions.readers import normalise_event_name, reader_tier, reader_type
from inkwell.sources import schemas
from tests.rows import pair


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


def with_params(spark, column, *pairs):
    rows = spark.createDataFrame([(list(pairs),)], f"p {schemas.PARAMS.simpleString()}")
    return rows.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        # First, middle, last and only one.
        ("https://www.example.com/a?id=7", "https://www.example.com/a"),
        # The mark in front goes with its parameter.
        ("https://www.example.com/a?id=7&x=1", "https://www.example.com/a&x=1"),
        ("https://www.example.com/a?x=1&id=7&y=2", "https://www.example.com/a?x=1&y=2"),
        ("https://www.example.com/a?x=1&token=q%20w%2Bz", "https://www.example.com/a?x=1"),
        # Behind other marks.
        ("https://www.example.com/a#x=1#id=7#y=2", "https://www.example.com/a#x=1#y=2"),
        ("https://www.example.com/a&token=7&id=8", "https://www.example.com/a"),
        ("https://www.example.com/a?token=7#id=8#y=2", "https://www.example.com/a#y=2"),
        # Names that only contain one of the list.
        ("https://www.example.com/a?idx=7&x=1", "https://www.example.com/a?idx=7&x=1"),
    ],
)
def test_named_query_parameters_are_removed(spark, given, expected):
    assert one(spark, urls.remove_params(F.lit(given), ["id", "token"])) == expected


@pytest.mark.parametrize(
    "given",
    [
        "https://www.example.com/b?id=7&x=1",
        "https://www.example.com/b#x=1?id",
        "https://www.example.com/b&id=7",
    ],
)
def test_all_query_parameters_are_removed(spark, given):
    assert one(spark, urls.remove_params(F.lit(given), ["*all*"])) == "https://www.example.com/b"


def test_url_parts(spark):
    url = F.lit("https://www.example.com/a/b/c/d?x=1&id=2#top")
    assert one(spark, urls.page_path(url)) == "/a/b/c/d"
    assert one(spark, urls.page_hostname(url)) == "example.com"
    assert one(spark, urls.page_query_string(url)) == "x=1&id=2#top"
    assert one(spark, urls.param_value(url, "id")) == "2"
    assert [one(spark, urls.path_level(url, n)) for n in range(1, 5)] == ["/a", "/b", "/c", "/d"]


def test_url_edge_cases(spark):
    # Without a path, the pattern gives back the last letter of the host.
    assert one(spark, urls.page_path(F.lit("https://www.example.com"))) == "m"
    assert one(spark, urls.page_path(F.lit("no url"))) is None
    assert one(spark, urls.page_query_string(F.lit("https://a.b/c"))) is None
    # Parameter names match as a whole.
    assert one(spark, urls.param_value(F.lit("https://a.b/c?paid=9&id=2"), "id")) == "2"
    assert one(spark, urls.path_level(F.lit("https://a.b/c?d"), 1)) == "/c"
    assert one(spark, urls.path_level(F.lit("https://a.b/"), 1)) is None


def test_typed_parameters(spark):
    pairs = (pair("a", "Text"), pair("n", 5), pair("f", 1.5), pair("a", "second"))
    p = F.col("p")
    assert with_params(spark, param(p, "a"), *pairs) == "Text"
    assert with_params(spark, param(p, "a", "lower_string"), *pairs) == "text"
    assert with_params(spark, param(p, "n", "int"), *pairs) == 5
    assert with_params(spark, param(p, "f", "float"), *pairs) == 1.5
    assert with_params(spark, param(p, "f", "double"), *pairs) is None
    assert with_params(spark, param(p, "missing"), *pairs) is None
    assert with_params(spark, param(p, "a")) is None


@pytest.mark.parametrize(
    ("pairs", "expected"),
    [
        ([pair("ga_session_id", 42)], 42),
        ([pair("ga_session_id", "s1747075570$o5$g1")], 1747075570),
        ([pair("ga_session_id", "1747075570$o5")], 0),
        ([pair("ga_session_id", "sabc$x")], 0),
        ([], 0),
    ],
)
def test_session_id(spark, pairs, expected):
    assert with_params(spark, session_id(F.col("p")), *pairs) == expected


def test_session_engaged(spark):
    p = F.col("p")
    assert with_params(spark, session_engaged(p), pair("session_engaged", 1)) == 1
    assert with_params(spark, session_engaged(p), pair("session_engaged", "1")) == 1
    assert with_params(spark, session_engaged(p), pair("session_engaged", "0")) is None
    assert with_params(spark, session_engaged(p)) is None


def test_names(spark):
    assert column_name("sign-up now") == "sign_up_now"
    assert column_name("4th") == "_4th"
    assert one(spark, normalise_event_name(F.lit(" Page View "))) == "page_view"


CHANNELS = [
    (None, None, None, None, "Direct"),
    ("(direct)", "(none)", None, None, "Direct"),
    ("(direct)", "(not set)", None, None, "Direct"),
    ("x", "y", None, "a cross-network b", "Cross-network"),
    ("amazon", "cpc", "SOURCE_CATEGORY_SHOPPING", None, "Paid Shopping"),
    ("x", "paid", None, "spring shop", "Paid Shopping"),
    ("google", "cpc", "SOURCE_CATEGORY_SEARCH", None, "Paid Search"),
    ("facebook", "paid-social", "SOURCE_CATEGORY_SOCIAL", None, "Paid Social"),
    ("youtube", "ppc", "SOURCE_CATEGORY_VIDEO", None, "Paid Video"),
    ("x", "banner", None, None, "Display"),
    ("x", "retargeting", None, None, "Paid Other"),
    ("amazon", "y", "SOURCE_CATEGORY_SHOPPING", None, "Organic Shopping"),
    ("x", "y", None, "shopping", "Organic Shopping"),
    ("facebook", "y", "SOURCE_CATEGORY_SOCIAL", None, "Organic Social"),
    ("x", "sm", None, None, "Organic Social"),
    ("youtube", None, "SOURCE_CATEGORY_VIDEO", None, "Organic Video"),
    ("x", "my-video-ad", None, None, "Organic Video"),
    ("google", None, "SOURCE_CATEGORY_SEARCH", None, "Organic Search"),
    ("x", "organic", None, None, "Organic Search"),
    ("x", "referral", None, None, "Referral"),
    ("e-mail", "y", None, None, "Email"),
    ("x", "email", None, None, "Email"),
    ("x", "affiliate", None, None, "Affiliates"),
    ("x", "audio", None, None, "Audio"),
    ("sms", None, None, None, "SMS"),
    ("x", "app-push", None, None, "Mobile Push Notifications"),
    ("x", "mobile app", None, None, "Mobile Push Notifications"),
    ("firebase", None, None, None, "Mobile Push Notifications"),
    ("x", "y", None, "workshops", "Unassigned"),
    ("x", "y", None, "eshop", "Organic Shopping"),
    ("(direct)", None, None, None, "Unassigned"),
    ("", "", "", "", "Unassigned"),
    (None, "y", None, None, "Unassigned"),
]


def test_every_channel(spark):
    rows = spark.createDataFrame(CHANNELS, "s string, m string, c string, k string, expected string")
    channel = channels.default_channel(F.col("s"), F.col("m"), F.col("c"), F.col("k"))
    wrong = rows.withColumn("channel", channel).filter("channel <> expected").collect()
    assert wrong == []


def test_gclid_repair(spark):
    cases = [
        ("https://a.b/?gclid=1", None, None, None, "google", "cpc", "(cpc)"),
        ("https://a.b/?gclid=1", "bing", "organic", "(organic)", "bing", "cpc", "(cpc)"),
        ("https://a.b/?gclid=1", "bing", "email", "spring", "bing", "email", "spring"),
        ("https://a.b/", None, "organic", None, None, "organic", None),
        (None, None, None, None, None, None, None),
    ]
    rows = spark.createDataFrame(cases, "u string, s string, m string, k string, es string, em string, ek string")
    fixed = channels.gclid_repair(F.col("u"), F.col("s"), F.col("m"), F.col("k"))
    for row in rows.withColumns(fixed).collect():
        assert (row.event_source, row.event_medium, row.event_campaign) == (row.es, row.em, row.ek)


def test_reader_type_around_the_subscription(spark):
    day = dt.date
    cases = [
        (None, None, None, None, "anonymous", "n/a"),
        ("u", None, None, None, "registered", "n/a"),
        ("u", day(2024, 1, 6), None, "basic", "registered", "n/a"),
        ("u", day(2024, 1, 5), None, "basic", "subscriber", "basic"),
        ("u", day(2024, 1, 1), None, None, "subscriber", "unknown"),
        ("u", day(2024, 1, 1), day(2024, 1, 5), "basic", "registered", "n/a"),
        ("u", day(2024, 1, 1), day(2024, 1, 6), "basic", "subscriber", "basic"),
    ]
    rows = spark.createDataFrame(cases, "u string, s date, c date, t string, type string, tier string")
    today = F.lit(day(2024, 1, 5))
    args = today, F.col("u"), F.col("s"), F.col("c")
    shown = rows.select("*", reader_type(*args).alias("x"), reader_tier(*args, F.col("t")).alias("y"))
    for row in shown.collect():
        assert (row.x, row.y) == (row.type, row.tier)
