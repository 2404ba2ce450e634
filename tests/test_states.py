"""States that a daily run extends: clients, sessions, users."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from inkwell.plans import clients
from inkwell.plans.warehouse import RELATIONS
from tests.rows import DAY, hit, micros, warehouse
from tests.test_plans import plan

START = micros("2024-01-01T12:00:00")
FIRST = dt.date(2024, 1, 1)
NAMES = ("staged_events", "session_days", "session_facts", "client_days", "client_states", "totals")
SHOWN = (
    "user_id_mapping user_properties client_first_last_events client_first_last_page_views sessions client_facts "
    "user_facts client_dimension"
).split()


def rows(w):
    return {name: sorted(w.relation(name).collect(), key=repr) for name in SHOWN}


def history(days: int, changed: bool) -> list[dict]:
    """Hits of a few clients; a client changes its login, a session goes over many days."""
    out = []
    for n in range(days):
        at = START + n * DAY
        out.append(hit("page_view", at, client="a", session=n // 3, user_id="u1" if n < 5 else "u2", page_location=f"https://x/{n}"))
        out.append(hit("page_view", at + 5, client="b", session=1, event_value_in_usd=0.1 + n, geo={"city": f"c{n}"}))
        out.append(hit("scroll", at + 7, client="c", session=n, user_id="u1" if n % 4 == 0 else None, engagement_time_msec=n))
        out.append(hit("page_view", at + 9, client=None, session=None))
        if n == 1 or changed:
            out.append(hit("newsletter_signup", at - 3, client="d", session=2, user_id="u2" if n > 6 else None, session_engaged="1",
                           properties={"subscription_tier": f"t{n}"} if n % 2 else None))
    return out


def test_daily_runs_give_the_results_of_one_run_over_all_days(spark, tmp_path):
    all_hits = history(10, True)
    # A run lacks some hits of its last two days; one that it has is gone later.
    gone = hit("page_view", START + 8 * DAY, client="e", session=7, user_id="u1")

    def lacking(after: int) -> list[dict]:
        return [h for i, h in enumerate(all_hits) if h["event_timestamp"] < START + after * DAY or i % 3]

    for day, hits in {6: lacking(5), 8: [*lacking(7), gone], 9: all_hits}.items():
        until = START + day * DAY + DAY // 3
        w = warehouse(spark, tmp_path / "daily", [h for h in hits if h["event_timestamp"] < until])
        w.build(FIRST + dt.timedelta(days=day), NAMES)
    whole = warehouse(spark, tmp_path / "whole", all_hits)
    assert rows(w) == rows(whole)


def test_a_day_that_vanished_takes_its_states_with_it(spark, tmp_path):
    hits = history(9, False)
    w = warehouse(spark, tmp_path, hits)
    w.build(FIRST + dt.timedelta(days=8), NAMES)
    before = [h for h in hits if not 6 * DAY <= h["event_timestamp"] - START < 8 * DAY]
    again = warehouse(spark, tmp_path, before)
    again.build(FIRST + dt.timedelta(days=8), NAMES)
    assert rows(again) == rows(warehouse(spark, tmp_path / "whole", before))


def test_a_user_that_a_client_leaves_keeps_the_first_moment_of_the_others(spark, tmp_path):
    hits = [
        hit("page_view", START, client="a", session=1, user_id="u1"),
        hit("page_view", START + DAY, client="b", session=1, user_id="u1"),
        hit("page_view", START + 8 * DAY, client="a", session=2, user_id="u2"),
        hit("page_view", START + 8 * DAY, client="z", session=1, user_id="only"),
        hit("page_view", START + 9 * DAY, client="z", session=1, user_id="other"),
    ]
    for day in (5, 8, 9):
        seen = [h for h in hits if h["event_timestamp"] <= START + day * DAY]
        w = warehouse(spark, tmp_path, seen)
        w.build(FIRST + dt.timedelta(days=day), NAMES)
    users = {r.user_id_or_client_key: (r.first_seen_timestamp - START, r.count_sessions) for r in w.relation("user_facts").collect()}
    assert users == {"u1": (DAY, 1), "u2": (0, 2), "other": (8 * DAY, 1)}


def test_merging_is_associative_and_in_any_order(spark, tmp_path):
    w = warehouse(spark, tmp_path, history(8, True))
    days, config = w.table("client_days").drop("event_date_dt"), w.config
    odd = F.pmod(F.hash("first_event.event_key"), F.lit(3))
    parts = [clients.merged(days.where(odd == n), config) for n in (2, 0, 1)]
    twice = clients.merged(clients.merged(parts[0].union(parts[1]), config).union(parts[2]), config)
    assert sorted(twice.collect(), key=repr) == sorted(clients.merged(days, config).collect(), key=repr)


def test_a_run_reads_staged_hits_of_its_window_once(spark, tmp_path):
    w = warehouse(spark, tmp_path, history(9, True))
    w.build(FIRST + dt.timedelta(days=8), NAMES)
    for name in SHOWN:
        assert "staged_events" not in plan(w.relation(name)), name
    for name in ("client_dimension", "client_facts", "user_facts"):
        assert not re.search("Join|Exchange", plan(w.relation(name))), name
    text = plan(RELATIONS["client_days"].build(w))
    assert len(re.findall(r"Location: .*?/staged_events\]", text)) == 1


def test_a_broken_run_leaves_no_closed_states_behind(spark, tmp_path):
    hits = history(9, True)
    w = warehouse(spark, tmp_path, hits)
    w.build(FIRST + dt.timedelta(days=8), NAMES)
    closed = next((tmp_path / "totals__closed").iterdir())
    assert closed.name == "until=2024-01-05"
    (closed / "user_totals" / "_SUCCESS").unlink()
    again = warehouse(spark, tmp_path, hits)
    again.build(FIRST + dt.timedelta(days=8), NAMES)
    assert rows(again) == rows(warehouse(spark, tmp_path / "whole", hits))


def test_days_built_anew_open_the_closed_states(spark, tmp_path):
    w = warehouse(spark, tmp_path, history(9, False))
    w.build(FIRST + dt.timedelta(days=8), NAMES)
    assert (tmp_path / "totals__closed").exists()
    w._reopen("session_facts")
    assert not (tmp_path / "totals__closed").exists() and (tmp_path / "client_states__closed").exists()


def test_sums_of_money_are_taken_off_without_a_remainder(spark, tmp_path):
    hits = [hit("page_view", START + n * DAY, client="a", session=1, event_value_in_usd=0.1, user_id=f"u{n // 6}") for n in range(9)]
    for day in (5, 8):
        w = warehouse(spark, tmp_path, hits[: day + 1])
        w.build(FIRST + dt.timedelta(days=day), NAMES)
    (user,) = w.relation("user_facts").collect()
    assert (user.user_id_or_client_key, user.sum_event_value_in_usd) == ("u1", 0.9)
