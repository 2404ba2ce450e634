"""Physical plans keep the shape that large tables need."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from fixtures import registered
from inkwell.plans.dashboards import named_query

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def w(spark):
    return registered.warehouse(spark, SMALL)


def test_copies_are_dropped_before_the_shuffle(w):
    text = plan(w.relation("base_events"))
    tree = text.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2 and tree.count("Exchange") == 1
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange") > tree.index("WindowGroupLimit")


def test_a_day_filter_reaches_the_partitions_below_the_deduplication(w):
    text = plan(w.relation("base_events").filter(F.col("event_date_dt") >= "2024-01-20"))
    assert re.search(r"PartitionFilters: .*2024-01-20", text)


def test_parameters_read_only_the_value_fields_in_use(w):
    text = plan(w.relation("paywall_daily"))
    assert "event_params:array<struct<key:string,value:struct<string_value:string>>>" in text
    assert "In(event_name, [paywall_click,paywall_impression])" in text


def test_metric_queries_scan_few_columns_of_the_days_in_range(w):
    text = plan(named_query(w, "overview.channelsQ", registered.RANGE))
    assert "Join" not in text
    assert re.search(r"PartitionFilters: .*2024-01-03.*2024-01-28", text)
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert len(schema.split(",")) == 3


def test_session_marts_need_no_join_with_each_other(w):
    assert "Join" not in plan(w.relation("session_facts"))
    assert "Join" not in plan(w.relation("session_dimension"))
    assert "Join" not in plan(w.relation("traffic_sources_daily"))
    assert "Join" not in plan(w.relation("page_engaged_time"))


def test_no_cross_joins_and_no_python(spark, w):
    for name, query in registered.queries().items():
        text = plan(query(spark, SMALL))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
            assert operator not in text, (name, operator)


def test_subscriptions_do_not_go_back_to_all_hits(w):
    for name in ("subscription_rows", "subscription_last_touch", "journeys", "buyers"):
        text = plan(w.relation(name))
        scans = re.findall(r"Location: .*?/(\w+)\]", text)
        assert "staged_events" not in scans, name
    for name in ("touch_hits", "subscribe_days"):
        assert re.findall(r"Location: .*?/(\w+)\]", plan(w.relation(name))).count("staged_events") == 1


def test_totals_and_event_metrics_read_the_daily_counts(w):
    queries = registered.queries()
    for name in ("mq12_event_state", "mq14_crm_totals", "mq15_content_totals", "cube_events_measures"):
        text = plan(queries[name](w.spark, SMALL))
        assert "events_daily" in text and "staged_events" not in text, name


def test_checks_read_the_staged_hits_for_their_own_keys_only(w):
    text = plan(registered.queries()["t08_all_checks"](w.spark, SMALL))
    assert len(re.findall(r"Location: .*?/staged_events\]", text)) <= 1
