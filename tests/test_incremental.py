from __future__ import annotations

import datetime as dt
import glob
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fixtures import registered
from inkwell.config import EngineConfig
from inkwell.plans import sessions
from inkwell.plans.warehouse import RELATIONS
from inkwell.sources.readers import read_accounts, read_articles, read_events, read_source_categories
from inkwell.rebuilds import incremental
from tests.rows import DAY, account, article, export, hit, micros, staged, warehouse

START = micros("2024-01-01T12:00:00")
AS_OF = dt.date(2024, 1, 7)
CONFIG = EngineConfig()


def facts(rows):
    return sessions.session_facts(sessions.session_days(rows, CONFIG), CONFIG)


def rebuild(spark, path, rows, **more):
    incremental.rebuild_window(
        facts,
        rows,
        path,
        source_day="event_date_dt",
        day="session_partition_date",
        as_of=AS_OF,
        late_days=3,
        **more,
    )
    return spark.read.schema(facts(rows).schema).parquet(path)


def by_day(df):
    return {str(r[0]): r[1] for r in df.groupBy("session_partition_date").count().collect()}


def test_window_has_one_day_more_than_the_late_days(spark):
    days = spark.createDataFrame([(AS_OF - dt.timedelta(days=n),) for n in range(-1, 6)], "day date")
    kept = days.filter(incremental.in_window("day", AS_OF, 3)).orderBy("day").collect()
    assert [str(r.day) for r in kept] == ["2024-01-04", "2024-01-05", "2024-01-06", "2024-01-07"]


def test_late_rows_repair_the_window_and_nothing_else(spark, tmp_path):
    on_time = [hit("page_view", START + n * DAY, session=n) for n in range(7)]
    late = [hit("page_view", START + n * DAY + 1, session=n) for n in (0, 4)]
    late += [hit("scroll", START + 5 * DAY, client="new", session=9)]
    path = str(tmp_path / "facts")
    incremental.overwrite(facts(staged(spark, on_time)), path, "session_partition_date")
    complete = staged(spark, on_time + late)
    repaired = rebuild(spark, path, complete)
    window = incremental.in_window("session_partition_date", AS_OF, 3)
    full = facts(complete).filter(window)
    columns = full.columns
    assert repaired.filter(window).select(columns).exceptAll(full).isEmpty()
    assert full.exceptAll(repaired.filter(window).select(columns)).isEmpty()
    # The late row of the first day lies outside the window and stays unseen.
    old = repaired.filter(F.col("session_partition_date") == "2024-01-01").collect()
    assert [r.session_partition_count_page_views for r in old] == [1]


def test_rows_whose_source_is_gone_disappear(spark, tmp_path):
    rows = [hit("page_view", START + 5 * DAY, session=n) for n in (1, 2)]
    path = str(tmp_path / "facts")
    incremental.overwrite(facts(staged(spark, rows)), path, "session_partition_date")
    assert by_day(rebuild(spark, path, staged(spark, rows[:1]))) == {"2024-01-06": 1}


def test_a_day_without_rows_disappears_as_well(spark, tmp_path):
    rows = [hit("page_view", START + n * DAY, session=n) for n in (0, 4, 5)]
    path = str(tmp_path / "facts")
    incremental.overwrite(facts(staged(spark, rows)), path, "session_partition_date")
    assert by_day(rebuild(spark, path, staged(spark, rows[:2]))) == {"2024-01-01": 1, "2024-01-05": 1}
    assert by_day(rebuild(spark, path, staged(spark, rows[:1]))) == {"2024-01-01": 1}


def test_a_second_application_finds_the_tables_and_extends_them(spark, tmp_path):
    rows = [hit("page_view", START + n * DAY, session=n) for n in range(7)]
    names = ("staged_events", "session_days", "session_facts", "paywall_daily")
    first = warehouse(spark, tmp_path, rows[:5])
    first.build(AS_OF - dt.timedelta(days=2), names)
    before = set(tmp_path.rglob("*.parquet"))
    again = warehouse(spark, tmp_path, rows)
    assert by_day(again.table("session_facts")) == {f"2024-01-0{n}": 1 for n in range(1, 6)}
    assert set(tmp_path.rglob("*.parquet")) == before
    again.build(AS_OF, names)
    assert by_day(again.table("session_facts")) == {f"2024-01-0{n}": 1 for n in range(1, 8)}
    # Only the window was written.
    kept = {p for p in before if "2024-01-03" in str(p) and "session_partition_date" in str(p)}
    assert kept and kept <= set(tmp_path.rglob("*.parquet"))


def test_a_changed_source_day_is_rebuilt_with_what_depends_on_it(spark, tmp_path):
    config = EngineConfig(lookback_days=3)
    hits = [
        hit("page_view", START + n * DAY, session=n, source="google" if n == 2 else None, medium="organic" if n == 2 else None)
        for n in range(25)
    ]
    names = ("staged_events", "session_days", "session_traffic_sources", "last_non_direct", "session_activity", "paywall_daily", "client_days", "client_states")
    late = hit("page_view", START + 3 * DAY + 9, client="new", session=1)
    gone = hits[20]
    first = warehouse(spark, tmp_path, hits, config=config)
    assert first.refresh(names) == dict.fromkeys(["events", *names], set())
    first.build(dt.date(2024, 1, 25), names)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    again = warehouse(spark, tmp_path, [h for h in hits if h is not gone] + [late], config=config)
    written = again.refresh(names)
    day = dt.date(2024, 1, 1)
    moved = {day + dt.timedelta(days=n) for n in (3, 20)}
    widened = {d + dt.timedelta(days=n) for d in moved for n in range(4)}
    assert written["events"] == written["staged_events"] == written["session_days"] == moved
    assert written["last_non_direct"] == written["session_activity"] == widened
    whole = warehouse(spark, tmp_path / "whole", [h for h in hits if h is not gone] + [late], config=config)
    for name in ("session_days", "last_non_direct", "session_activity", "paywall_daily", "client_states"):
        ordered = [sorted(w.table(name).select(*sorted(w.table(name).columns)).drop("session_number").collect(), key=repr) for w in (again, whole)]
        assert ordered[0] == ordered[1], name
    kept = {p for p in before if p.exists() and p.stat().st_mtime_ns == before[p]}
    rewritten = {str(p).split("date")[-1] for p in set(before) - kept if "/session_days/" in str(p)}
    assert {r[4:14] if r.startswith("_dt") else r[1:11] for r in rewritten} == {d.isoformat() for d in moved}
    assert again.refresh(names) == dict.fromkeys(["events", *names], set())


def test_a_replacement_that_broke_off_is_carried_through(spark, tmp_path, monkeypatch):
    rows = [hit("page_view", START + n * DAY, session=n) for n in (0, 4, 5)]
    names = ("staged_events", "session_days", "session_facts")
    warehouse(spark, tmp_path, rows).build(AS_OF, names)
    again = warehouse(spark, tmp_path, rows[:2])

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(incremental, "overwrite_days", broken)
        again.build(AS_OF, names[:1])
    assert (tmp_path / "staged_events__window" / "_days").exists()
    assert warehouse(spark, tmp_path, rows[:2]).table("staged_events").count() == 2
    assert not (tmp_path / "staged_events__window").exists()


def test_lookback_is_read_but_not_written(spark, tmp_path):
    config = EngineConfig(lookback_days=3)
    hits = [
        hit("page_view", START, session=1, source="google", medium="organic"),
        hit("page_view", START + 3 * DAY, session=2),
        hit("page_view", START + 4 * DAY, session=3),
    ]
    days = sessions.session_days(staged(spark, hits), config)
    categories = spark.createDataFrame([], "source string, source_category string")
    sources = sessions.session_traffic_sources(days, categories)
    path = str(tmp_path / "lnd")
    incremental.rebuild_window(
        lambda rows: sessions.last_non_direct(rows, config),
        sources,
        path,
        source_day="session_partition_date",
        day="session_partition_date",
        as_of=AS_OF,
        late_days=3,
        lookback_days=3,
    )
    rows = spark.read.parquet(path).orderBy("session_partition_date").collect()
    assert [(str(r.session_partition_date), r.last_non_direct_source) for r in rows] == [
        ("2024-01-04", "google"),
        ("2024-01-05", "(direct)"),
    ]


def test_full_rebuild_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental.overwrite(spark.range(5), path)
    incremental.overwrite(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_readers(spark, tmp_path):
    hits = [hit("scroll", START + n * DAY) for n in range(3)]
    incremental.overwrite(export(spark, hits), str(tmp_path / "e"), "event_date")
    events = read_events(spark, str(tmp_path / "e"), "20240102")
    assert sorted(r.event_date for r in events.collect()) == ["20240102", "20240103"]
    spark.createDataFrame([article(1)], read_articles(spark, str(tmp_path / "e")).schema).write.parquet(
        str(tmp_path / "a")
    )
    assert read_articles(spark, str(tmp_path / "a")).first().title == "T1"
    spark.createDataFrame([account("u")], read_accounts(spark, str(tmp_path / "e")).schema).write.parquet(
        str(tmp_path / "u")
    )
    assert read_accounts(spark, str(tmp_path / "u")).first().country == "US"
    (tmp_path / "c.csv").write_text("source,source_category\ngoogle,SOURCE_CATEGORY_SEARCH\n")
    (row,) = read_source_categories(spark, str(tmp_path / "c.csv")).collect()
    assert tuple(row) == ("google", "SOURCE_CATEGORY_SEARCH")


def test_days_are_utc(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            warehouse(spark, tmp_path, [])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_tables_go_to_the_folder_the_cluster_names():
    def session(master, folder):
        conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app-1"))

    assert registered._root(session("yarn", "/shared/folder/")) == "/shared/folder/inkwell/app-1"
    assert registered._root(session("local[2]", None)).endswith("/inkwell/app-1")
    with pytest.raises(ValueError, match="shared folder"):
        registered._root(session("yarn", None))


def test_session_days_are_written_where_they_were_grouped(spark, tmp_path):
    """Not shuffled by day after the shuffle by session, and packed."""
    w = warehouse(spark, tmp_path, [hit("page_view", f"2024-01-0{d}T10:00:00", session=d) for d in (1, 2, 3)])
    assert by_day(w.table("session_days")) == {f"2024-01-0{d}": 1 for d in (1, 2, 3)}
    assert RELATIONS["session_days"].dealt and RELATIONS["session_activity"].dealt
    (file,) = glob.glob(f"{w.root}/session_days/session_partition_date=2024-01-02/*.parquet")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
