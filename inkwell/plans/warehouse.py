"""The relations by name, and the tables they are kept in."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.config import EngineConfig
from inkwell.plans import actives, articles, clients, pages, sessions, staging, subscriptions
from inkwell.rebuilds.incremental import (
    day_digests,
    finish,
    in_window,
    overwrite,
    replace_days,
    replace_window,
    window_start,
)
from inkwell.rebuilds.states import Bundle, ClosedStates, as_it_is, extended


@dataclass(frozen=True)
class Relation:
    """How a relation is built, and the day column its table is partitioned by.

    ``lookback``: days before a window that its rows depend on; None for a relation whose rows
    depend on the whole history, which is always built anew.
    """

    build: Callable[[Warehouse], DataFrame]
    day: str | None = None
    lookback: Callable[[EngineConfig], int | None] = lambda config: 0
    # Rows that a run adds to those that are there, from its window; nothing that is there changes.
    added: Callable[[_Window, DataFrame], DataFrame] | None = None
    # Written whole without a shuffle by day: rows come by day, as those of the export do, or have just been
    # shuffled by a key as fine as the rows, and each task then writes a file for each of its days.
    dealt: bool = False
    # A relation that a run brings up to date in a way of its own.
    extended: Callable[[Warehouse, dt.date], None] | None = None


@dataclass
class Warehouse:
    """Relations over one set of inputs.

    Inputs are read where they lie. Those named in ``computed`` are not stored yet and
    are written like the tables below; those with days come dealt out by day.

    ``relation`` composes a relation lazily from the tables below it; ``table`` writes
    it once and reads it back. Deduplicating and keying the export is the most expensive
    step, so all marts start from the written staged events, and metric queries start
    from the written marts, where they scan a few columns of the days in range. A lost
    executor costs its tasks only, since the tables are on shared storage.
    """

    spark: SparkSession
    inputs: dict[str, Callable[[], DataFrame]]
    config: EngineConfig
    root: str
    computed: frozenset[str] = frozenset()
    _tables: dict[str, DataFrame] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT", "Z"):
            raise ValueError("days are cut in UTC: set spark.sql.session.timeZone to UTC")

    def relation(self, name: str) -> DataFrame:
        if name in self.inputs:
            return self.inputs[name]()
        return RELATIONS[name].build(self)

    def table(self, name: str) -> DataFrame:
        if name in self.inputs and name not in self.computed:
            return self.inputs[name]()
        if name not in self._tables and not self.open(name):
            df = self.relation(name)
            path = f"{self.root}/{name}"
            if name in self.computed:
                overwrite(df, path, INPUT_DAYS.get(name), dealt=True)
            else:
                overwrite(df, path, RELATIONS[name].day, RELATIONS[name].dealt)
            self._tables[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._tables[name]

    def event_type(self, name: str) -> DataFrame:
        return staging.event_type(self.table("staged_events"), name, self.config)

    def open(self, name: str) -> bool:
        """Take up the table that an earlier application left below the root, if there is one.

        A table without any file has no schema to read; it is built anew.
        """
        path = f"{self.root}/{name}"
        self._finish(name)
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target):
            return False
        try:
            self._tables[name] = self.spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return False
        return True

    def _finish(self, name: str) -> None:
        """Carry through a run that broke off while it replaced days of this table."""
        path, day = f"{self.root}/{name}", RELATIONS[name].day if name in RELATIONS else None
        under_way = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}__window/_days/_SUCCESS")
        if day and under_way.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(under_way):
            finish(self.spark, path, day, self.spark.read.parquet(path).schema)

    def rebuild(self, name: str, as_of: dt.date) -> None:
        """Bring one table up to date: the days from ``late_days`` before ``as_of`` to ``as_of``
        of a table with days (I1, I8), the whole of any other (I6).

        A window is built by the relation's own function over tables that are cut to the window
        and the relation's lookback. Days that lost all their rows go.
        """
        if name in BUNDLES:
            self.extend(name, as_of)
            return
        kind, path = RELATIONS[name], f"{self.root}/{name}"
        lookback = kind.lookback(self.config)
        known = name in self._tables or self.open(name)
        if known and kind.added:
            rows = kind.added(_Window(self, as_of, self.config.late_days), self._tables[name])
            rows.write.mode("append").parquet(path)
            self._tables[name] = self.spark.read.schema(rows.schema).parquet(path)
            return
        if known and kind.extended:
            kind.extended(self, as_of)
            return
        if not known or kind.day is None or lookback is None:
            rows = self.relation(name)
            overwrite(rows, path, kind.day, kind.dealt)
            self._reopen(name)
        else:
            late = self.config.late_days
            rows = kind.build(_Window(self, as_of, late + lookback)).where(in_window(kind.day, as_of, late))
            replace_window(rows, path, kind.day, as_of, late)
        self._tables[name] = self.spark.read.schema(rows.schema).parquet(path)

    def folded(self, table: str) -> DataFrame:
        """A table of a bundle, from all days."""
        (bundle,) = [b for b in (make(self.config) for make in BUNDLES.values()) if table in b.tables]
        return bundle.advance(None, {n: self.table(n) for n in bundle.days}, as_it_is)[table]

    def extend(self, name: str, as_of: dt.date) -> None:
        """Bring the tables of a bundle up to date, reading only days since its closed states."""
        bundle = BUNDLES[name](self.config)
        closed = ClosedStates(self.spark, f"{self.root}/{name}__closed", bundle)

        def days(table: str, after: dt.date | None, to: dt.date | None) -> DataFrame:
            rows, day = self.table(table), F.col(RELATIONS[table].day)
            rows = rows if after is None else rows.where(day > F.lit(after))
            return rows if to is None else rows.where(day <= F.lit(to))

        def keep(rows: DataFrame, part: str) -> DataFrame:
            path = f"{self.root}/{name}__parts/{part}"
            overwrite(rows, path)
            return self.spark.read.schema(rows.schema).parquet(path)

        until = as_of - dt.timedelta(days=self.config.late_days + 1)
        for table, rows in extended(closed, days, until, keep).items():
            overwrite(rows, f"{self.root}/{table}")
            self._tables[table] = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{table}")

    def extend_journeys(self, as_of: dt.date) -> None:
        """Add the window's hits of all subscribers, and of those who are new or changed the hits before it.

        A changed subscriber gets a new version; rows of the old one are no longer read. The versions
        are written last, so a run that breaks off changes nothing that is read before its window.
        """
        path, day, version = f"{self.root}/journey_hits", "event_date_dt", uuid.uuid4().hex
        known, people_path = self.table("journey_people"), f"{self.root}/journey_people"
        people = subscriptions.changed_people(self.table("buyers"), known, version)
        overwrite(people, f"{people_path}__next")
        people = self.spark.read.schema(people.schema).parquet(f"{people_path}__next")
        touches = self.table("touch_hits")
        start = window_start(as_of, self.config.late_days)
        changed = people.where(F.col("version") == version)
        if not changed.isEmpty():
            older = subscriptions.journey_hits(touches.where(F.col(day) < F.lit(start)), changed)
            older.hint("rebalance", day).write.mode("append").partitionBy(day).parquet(path)
        rows = subscriptions.journey_hits(touches.where(in_window(day, as_of, self.config.late_days)), people)
        replace_window(rows, path, day, as_of, self.config.late_days)
        overwrite(people, people_path)
        self._tables["journey_hits"] = self.spark.read.schema(rows.schema).parquet(path)
        self._tables["journey_people"] = self.spark.read.schema(people.schema).parquet(people_path)

    def _reopen(self, name: str) -> None:
        """Closed states that were made from days which have been built anew are made again."""
        for bundle, make in BUNDLES.items():
            if name in make(self.config).days:
                ClosedStates(self.spark, f"{self.root}/{bundle}__closed", make(self.config)).forget()

    def refresh(self, names: tuple[str, ...] | None = None) -> dict[str, set[dt.date]]:
        """Rebuild what changed sources ask for, however old: the days whose digest differs from the one
        of the last refresh, and in each table the days that depend on such days.

        Returns the days that were written, by table. The first refresh only takes the digests.
        """
        path = f"{self.root}/source_days"
        now = day_digests(self.table("events"), INPUT_DAYS["events"])
        now = now.withColumn("day", F.to_date("day", "yyyyMMdd"))
        changed: dict[str, set[dt.date]] = {"events": set()}
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target):
            before = self.spark.read.schema(now.schema).parquet(path).withColumnsRenamed({"rows": "_rows", "digest": "_digest"})
            both = now.join(before, "day", "full")
            same = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest"))
            changed["events"] = {r.day for r in both.where(~same).select("day").collect()}
        for name in names or STORED:
            self._refresh(name, changed)
        overwrite(self.spark.createDataFrame(now.collect(), now.schema), path)
        return changed

    def _refresh(self, name: str, changed: dict[str, set[dt.date]]) -> None:
        if name in BUNDLES:
            bundle = BUNDLES[name](self.config)
            days = set().union(*(changed.get(n, set()) for n in bundle.days))
            if days:
                # Closed states may hold what these days were.
                ClosedStates(self.spark, f"{self.root}/{name}__closed", bundle).forget()
                self.extend(name, self.table(bundle.days[0]).agg(F.max(RELATIONS[bundle.days[0]].day)).first()[0])
            changed |= dict.fromkeys(bundle.tables, days)
            return
        kind = RELATIONS[name]
        used = _Uses(self)
        kind.build(used)
        lookback = kind.lookback(self.config)
        moved = set().union(*(changed.get(n, set()) for n in used.names))
        if not moved:
            changed[name] = set()
            return
        if kind.day is None or lookback is None:
            if kind.extended:
                # Made anew for the subscribers of now, all of one version.
                people = subscriptions.journey_people(self.table("buyers"))
                overwrite(people, f"{self.root}/journey_people")
                self._tables["journey_people"] = self.spark.read.schema(people.schema).parquet(f"{self.root}/journey_people")
            rows = self.relation(name)
            overwrite(rows, f"{self.root}/{name}", kind.day, kind.dealt)
            changed[name] = moved
        else:
            days = {d + dt.timedelta(days=n) for d in moved for n in range(lookback + 1)}
            source = {d - dt.timedelta(days=n) for d in days for n in range(lookback + 1)}
            rows = kind.build(_Days(self, source)).where(F.col(kind.day).isin(sorted(days)))
            replace_days(rows, f"{self.root}/{name}", kind.day, sorted(days))
            changed[name] = days
        self._tables[name] = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{name}")

    def build(self, as_of: dt.date, names: tuple[str, ...] | None = None) -> None:
        """A daily run: :meth:`rebuild` for the tables, each after those it is made from."""
        for name in names or STORED:
            self.rebuild(name, as_of)


class _Window:
    """A warehouse whose tables end where a window begins and ends; the relations see no other."""

    def __init__(self, whole: Warehouse, as_of: dt.date, days: int):
        self.whole, self.as_of, self.days = whole, as_of, days
        self.config = whole.config

    def table(self, name: str) -> DataFrame:
        rows = self.whole.table(name)
        if name in INPUT_DAYS:
            first = self.as_of - dt.timedelta(days=self.days)
            return rows.where(F.col(INPUT_DAYS[name]).between(f"{first:%Y%m%d}", f"{self.as_of:%Y%m%d}"))
        day = RELATIONS[name].day if name in RELATIONS else None
        return rows.where(in_window(day, self.as_of, self.days)) if day else rows

    def relation(self, name: str) -> DataFrame:
        if name in self.whole.inputs:
            return self.whole.relation(name)
        return RELATIONS[name].build(self)

    def event_type(self, name: str) -> DataFrame:
        return staging.event_type(self.table("staged_events"), name, self.config)


class _Days(_Window):
    """A warehouse whose tables have some days only."""

    def __init__(self, whole: Warehouse, days: set[dt.date]):
        self.whole, self.days, self.config = whole, sorted(days), whole.config

    def table(self, name: str) -> DataFrame:
        rows = self.whole.table(name)
        if name in INPUT_DAYS:
            return rows.where(F.col(INPUT_DAYS[name]).isin([f"{d:%Y%m%d}" for d in self.days]))
        day = RELATIONS[name].day if name in RELATIONS else None
        return rows.where(F.col(day).isin(self.days)) if day else rows


class _Uses(_Window):
    """A warehouse that notes the tables that a relation is made from."""

    def __init__(self, whole: Warehouse):
        self.whole, self.config, self.spark = whole, whole.config, whole.spark
        self.names: set[str] = set()

    def table(self, name: str) -> DataFrame:
        self.names.add(name)
        return self.whole.table(name)

    def folded(self, table: str) -> DataFrame:
        self.names |= {n for make in BUNDLES.values() for n in make(self.config).days if table in make(self.config).tables}
        return self.whole.folded(table)


INPUT_DAYS = {"events": "event_date"}

RELATIONS: dict[str, Relation] = {
    "base_events": Relation(
        lambda w: staging.base_events(w.table("events"), w.config), "event_date_dt", dealt=True
    ),
    "staged_events": Relation(
        lambda w: staging.staged_events(w.relation("base_events"), w.config), "event_date_dt", dealt=True
    ),
    "session_days": Relation(
        lambda w: sessions.session_days(w.table("staged_events"), w.config), "session_partition_date", dealt=True
    ),
    "session_traffic_sources": Relation(
        lambda w: sessions.session_traffic_sources(w.table("session_days"), w.table("source_categories")),
        "session_partition_date",
    ),
    "last_non_direct": Relation(
        lambda w: sessions.last_non_direct(w.table("session_traffic_sources"), w.config),
        "session_partition_date",
        lambda config: config.lookback_days,
    ),
    "session_conversions_daily": Relation(
        lambda w: sessions.session_conversions_daily(w.table("session_days"), w.config),
        "session_partition_date",
    ),
    "session_conversions": Relation(
        lambda w: sessions.session_conversions(w.table("session_conversions_daily"), w.config)
    ),
    "session_activity": Relation(
        lambda w: sessions.session_activity(w.table("session_days"), w.table("last_non_direct")),
        "session_partition_date",
        dealt=True,
    ),
    "session_dimension": Relation(
        lambda w: sessions.session_dimension(w.table("session_activity")), "session_partition_date"
    ),
    "session_facts": Relation(
        lambda w: sessions.session_facts(w.table("session_days"), w.config), "session_partition_date"
    ),
    "id_numbers": Relation(
        lambda w: actives.id_numbers(w.table("events_daily")),
        added=lambda w, known: actives.id_numbers(w.table("events_daily"), known),
    ),
    "activity_bitmaps": Relation(
        lambda w: actives.activity_bitmaps(
            w.table("events_daily"), w.table("session_activity"), w.table("id_numbers")
        ),
        "event_date",
    ),
    "client_days": Relation(
        lambda w: clients.client_days(w.table("staged_events"), w.config), "event_date_dt"
    ),
    "client_states": Relation(lambda w: w.folded("client_states")),
    "session_totals": Relation(lambda w: w.folded("session_totals")),
    "client_totals": Relation(lambda w: w.folded("client_totals")),
    "user_totals": Relation(lambda w: w.folded("user_totals")),
    "sessions": Relation(lambda w: clients.sessions(w.table("session_totals"))),
    "traffic_sources_daily": Relation(
        lambda w: sessions.traffic_sources_daily(w.table("session_activity"), w.config),
        "session_partition_date",
    ),
    "user_id_mapping": Relation(lambda w: clients.user_id_mapping(w.table("client_states"))),
    "user_properties": Relation(lambda w: clients.user_properties(w.table("client_states"), w.config)),
    "client_first_last_events": Relation(
        lambda w: clients.client_first_last_events(w.table("client_states"))
    ),
    "client_first_last_page_views": Relation(
        lambda w: clients.client_first_last_page_views(w.table("client_states"))
    ),
    "client_facts": Relation(lambda w: clients.client_facts(w.table("client_totals"), w.config)),
    "user_facts": Relation(lambda w: clients.user_facts(w.table("user_totals"), w.config)),
    "client_dimension": Relation(lambda w: clients.client_dimension(w.table("client_states"), w.config)),
    "page_conversions": Relation(lambda w: pages.page_conversions(w.table("staged_events"), w.config)),
    "page_engaged_time": Relation(lambda w: pages.page_engaged_time(w.table("staged_events"))),
    "pages": Relation(
        lambda w: pages.pages(
            w.event_type("page_view"), w.table("staged_events"), w.relation("page_engaged_time"), w.config
        ),
        "event_date_dt",
        lambda config: config.session_span_days,
    ),
    "articles_daily": Relation(
        lambda w: articles.articles_daily(w.table("staged_events"), w.table("articles")), "event_date_dt"
    ),
    "articles_by_reader_type": Relation(
        lambda w: articles.articles_by_reader_type(
            w.table("staged_events"), w.table("articles"), w.table("accounts")
        ),
        "event_date_dt",
    ),
    "paywall_daily": Relation(lambda w: articles.paywall_daily(w.table("staged_events")), "event_date_dt"),
    "paywall_sessions_daily": Relation(
        lambda w: articles.paywall_sessions_daily(w.table("staged_events")), "event_date_dt"
    ),
    "events_daily": Relation(lambda w: staging.events_daily(w.table("staged_events")), "event_date"),
    "touch_hits": Relation(lambda w: subscriptions.touch_hits(w.table("staged_events")), "event_date_dt"),
    "subscribe_days": Relation(lambda w: subscriptions.subscribe_days(w.table("staged_events")), "event_date_dt"),
    "subscribe_hits": Relation(lambda w: w.folded("subscribe_hits")),
    "buyers": Relation(lambda w: subscriptions.buyers(w.table("accounts"), w.table("subscribe_hits"))),
    "journey_people": Relation(lambda w: subscriptions.journey_people(w.table("buyers"))),
    "journey_hits": Relation(
        lambda w: subscriptions.journey_hits(w.table("touch_hits"), w.table("journey_people")),
        "event_date_dt",
        lambda config: None,
        extended=lambda w, as_of: w.extend_journeys(as_of),
    ),
    "journeys": Relation(
        lambda w: subscriptions.journeys(w.table("journey_hits"), w.table("journey_people"))
    ),
    "subscription_rows": Relation(
        lambda w: subscriptions.subscription_rows(
            w.table("buyers"),
            w.relation("journeys"),
            w.table("session_traffic_sources"),
            w.table("articles"),
        )
    ),
    "subscription_last_touch": Relation(
        lambda w: subscriptions.subscription_last_touch(w.table("subscription_rows"))
    ),
}

# The tables of a daily run, each after those it is made from.
STORED = (
    "staged_events",
    "session_days",
    "session_traffic_sources",
    "last_non_direct",
    "session_conversions_daily",
    "session_facts",
    "session_dimension",
    "session_activity",
    "traffic_sources_daily",
    "pages",
    "articles_daily",
    "articles_by_reader_type",
    "paywall_daily",
    "paywall_sessions_daily",
    "events_daily",
    "id_numbers",
    "activity_bitmaps",
    "client_days",
    "client_states",
    "totals",
    "touch_hits",
    "subscribe_days",
    "subscribe_state",
    "buyers",
    "journey_hits",
    "subscription_rows",
)

# Tables that are extended together, from closed states of their own.
BUNDLES: dict[str, Callable[[EngineConfig], Bundle]] = {
    "client_states": clients.client_states,
    "totals": clients.totals,
    "subscribe_state": lambda config: subscriptions.subscribe_hits(),
}
