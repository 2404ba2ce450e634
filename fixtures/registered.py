"""The registered queries: every operator over the given tables, by name.

Each takes the session and the folder of the tables. Results are shown with plain types
(days as text, moments as micros, whole numbers as bigint, fractions rounded), so that
they can be compared with those of another engine.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import tempfile
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import derived
from inkwell import fixed_values as fixed
from inkwell.config import EngineConfig, Parameter
from inkwell.functions import channels, keys, urls
from inkwell.functions.params import param
from inkwell.functions.readers import reader_tier, reader_type
from inkwell.operators.joins import lookup
from inkwell.operators.ordered import sessionise
from inkwell.plans import articles, clients, metrics, quality, sessions, staging, subscriptions
from inkwell.plans.checks import run_checks
from inkwell.plans.cubes import CUBES
from inkwell.plans.dashboards import NAMED_QUERIES, named_query
from inkwell.plans.metrics import DateRange, MetricQuery, metric_query
from inkwell.plans.warehouse import RELATIONS, Warehouse
from inkwell.rebuilds import incremental
from inkwell.sources import readers

SECTION_WALLS = {"politics": "hard", "sports": "metered", "culture": "metered", "lifestyle": "free"}
RANGE = DateRange.of("2024-01-03", "2024-01-27")
WIDE_RANGE = DateRange.of("2023-12-20", "2024-02-10")
PREVIOUS_RANGE = DateRange.of("2024-01-01", "2024-01-15")
CURRENT_RANGE = DateRange.of("2024-01-16", "2024-01-30")
LAST_DAY = dt.date(2024, 1, 30)
# The events cover 30 days, so a shorter lookback lets some campaigns expire.
CONFIG = EngineConfig(lookback_days=3, session_span_days=30)

Query = Callable[[SparkSession, str], DataFrame]
_warehouses: dict[tuple[str, str], Warehouse] = {}


def _root(spark: SparkSession) -> str:
    """Where this application keeps the tables of the registered queries: below the shared
    folder, or in a temporary one when a session without such a folder tries them out."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        shared = tempfile.mkdtemp(prefix="inkwell-")
    return f"{shared.rstrip('/')}/inkwell/{spark.sparkContext.applicationId}"


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of a folder of tables; its tables are written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        # The export has some hundred columns. Java never compiles methods of more than 8000
        # bytes, so above that Spark is to split the projection into smaller ones.
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
        # Tasks hold few days each: their wide rows are written to a file a day and not sorted by day.
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "64")
        # A task sorts what it groups before the shuffle: a split of wide hits is to fit its memory.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32m")
        inputs = {
            "events": lambda: derived.events(spark, sf_dir),
            "articles": lambda: derived.articles(spark, sf_dir),
            "accounts": lambda: derived.accounts(spark, sf_dir),
            "source_categories": lambda: derived.source_categories(_warehouses[key].table("events")),
        }
        root = f"{_root(spark)}/{len(_warehouses)}"
        computed = frozenset({"events", "articles", "accounts", "source_categories"})
        _warehouses[key] = Warehouse(spark, inputs, CONFIG, root, computed)
    return _warehouses[key]


def plain(df: DataFrame) -> DataFrame:
    """Columns as text, bigint, boolean and rounded double; nested columns are left out."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.StructType)):
            continue
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.unix_micros(column)
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.FractionalType):
            column = F.round(column.cast("double"), 6)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _relation(name: str, *dropped: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w.relation(name).drop(*dropped)


def _with_row_id(df: DataFrame, *columns) -> DataFrame:
    return df.select(F.col("batch_ordering_id").alias("row_id"), *columns)


# Columns of each event type beyond those of every hit.
_OWN = {
    "page_view": (
        "entrances value article_id section pagepath_level_1 pagepath_level_2 pagepath_level_3 pagepath_level_4 "
        "page_engagement_key"
    ),
    "session_start": "entrances value",
    "first_visit": "landing_page",
    "user_engagement": "engagement_time_msec session_engaged",
    "scroll": "percent_scrolled article_id",
    "click": (
        "entrances outbound link_url link_domain link_classes link_id click_element click_region click_tag_name "
        "click_url file_name"
    ),
    "file_download": (
        "entrances value file_extension file_name link_domain link_url link_text link_classes link_id"
    ),
    **dict.fromkeys(
        ("video_start", "video_progress", "video_complete"),
        "video_duration video_percent video_current_time video_url video_provider video_title visible",
    ),
    "view_search_results": "entrances search_term unique_search_term",
    "search": "search_term",
    "share": "method content_type item_id",
    "custom_event": "wall bundle_offer article_id",
    "bookmark": "article_id",
    "comment": "article_id",
    "newsletter_signup": "method",
    "paywall_impression": "",
    "paywall_click": "",
}


def _event_type(name: str) -> Callable[[Warehouse], DataFrame]:
    columns = ("event_timestamp", "client_key", *_OWN[name].split())
    return lambda w: _with_row_id(w.event_type(name), *columns)


def _custom_event(w: Warehouse) -> DataFrame:
    wanted = [Parameter("paywall_type", rename="wall"), Parameter("bundle_offer"), Parameter("article_id")]
    hits = staging.custom_event(w.table("staged_events"), "subscribe", wanted, w.config)
    return _with_row_id(hits, "event_timestamp", "client_key", *_OWN["custom_event"].split())


def _scratch(w: Warehouse, name: str) -> str:
    return f"{w.root}/scratch/{name}"


def _late_window_rebuild(w: Warehouse) -> DataFrame:
    """A table built before late hits came in, then repaired by rebuilding its window."""
    hits = w.table("staged_events")
    window = incremental.in_window("event_date_dt", LAST_DAY, w.config.late_days)
    early = hits.filter(~(window & (F.col("batch_ordering_id") % 30 < 10)))
    path = _scratch(w, "session_facts")

    def build(rows: DataFrame) -> DataFrame:
        return sessions.session_facts(sessions.session_days(rows, w.config), w.config)

    incremental.overwrite(build(early), path, "session_partition_date")
    incremental.rebuild_window(
        build,
        hits,
        path,
        source_day="event_date_dt",
        day="session_partition_date",
        as_of=LAST_DAY,
        late_days=w.config.late_days,
    )
    return w.spark.read.schema(build(hits).schema).parquet(path)


# Models that a daily run extends by a window of days.
INCREMENTAL = (
    "session_facts",
    "session_dimension",
    "session_traffic_sources",
    "last_non_direct",
    "traffic_sources_daily",
    "pages",
    "articles_daily",
    "articles_by_reader_type",
    "paywall_daily",
    "paywall_sessions_daily",
)


def _daily_run(name: str) -> Callable[[Warehouse], DataFrame]:
    """A table that lacked its last two days and part of another, after the daily run."""

    def run(w: Warehouse) -> DataFrame:
        inputs = {**w.inputs, **{n: lambda n=n: w.table(n) for n in _UPSTREAM if n != name}}
        daily = Warehouse(w.spark, inputs, w.config, _scratch(w, "daily"))
        day = RELATIONS[name].day
        full = w.relation(name)
        partial = (F.col(day) == LAST_DAY - dt.timedelta(days=2)) & (F.hash(*_plain_columns(full)) % 3 == 0)
        early = full.where((F.col(day) <= LAST_DAY - dt.timedelta(days=2)) & ~partial)
        incremental.overwrite(early, f"{daily.root}/{name}", day)
        daily.rebuild(name, LAST_DAY)
        return daily.table(name)

    return run


# Relations over states that a daily run extends, and columns that SQL does not have.
STATES = {
    "user_id_mapping": (),
    "user_properties": (),
    "client_first_last_events": ("first_event", "last_event"),
    "client_first_last_page_views": ("first_page_view_event_key", "last_page_view_event_key"),
    "sessions": (),
    "client_facts": (),
    "user_facts": (),
    "client_dimension": ("first_event", "last_event"),
    "subscription_last_touch": (),
}
# The tables that a run brings up to date for each kind of relation.
_STATE_TABLES = {
    "client_states": ("client_days", "client_states"),
    "totals": ("session_days", "session_facts", "client_days", "totals"),
    "journeys": ("touch_hits", "subscribe_days", "subscribe_state", "buyers", "journey_hits", "subscription_rows"),
}
_KINDS = {
    **dict.fromkeys(("sessions", "client_facts", "user_facts"), "totals"),
    "subscription_last_touch": "journeys",
}
_extended: dict[tuple[str, str, str], Warehouse] = {}


def _two_runs(w: Warehouse, kind: str) -> Warehouse:
    """A warehouse after a daily run that missed a third of the last two days' hits, and the run two
    days later over all hits: sessions go on, clients move between logins, days come in. It has the
    tables of one kind, in a folder of their own."""
    key = (w.spark.sparkContext.applicationId, w.root, kind)
    if key not in _extended:
        hits, root = w.table("staged_events"), _scratch(w, f"extended/{kind}")
        first_day = LAST_DAY - dt.timedelta(days=2)
        missed = (F.col("event_date_dt") >= first_day - dt.timedelta(days=1)) & (F.col("batch_ordering_id") % 3 == 0)
        early = hits.where((F.col("event_date_dt") <= first_day) & ~missed)
        people = w.table("accounts")
        # Some subscribed between the runs, as far as the first one knew.
        bought = F.when(F.crc32(F.col("user_id").cast("binary")) % 3 > 0, F.col("subscription_date"))
        inputs = {n: lambda n=n: w.table(n) for n in ("articles", "session_traffic_sources")}
        before = {"staged_events": lambda: early, "accounts": lambda: people.withColumn("subscription_date", bought)}
        Warehouse(w.spark, inputs | before, w.config, root).build(first_day, _STATE_TABLES[kind])
        now = {"staged_events": lambda: hits, "accounts": lambda: people}
        later = Warehouse(w.spark, inputs | now, w.config, root)
        later.build(LAST_DAY, _STATE_TABLES[kind])
        _extended[key] = later
    return _extended[key]


def _changed_days(w: Warehouse) -> DataFrame:
    """Session facts after hits of a day twenty days back came in: only what depends on that day is built."""
    export, names = w.table("events"), ("staged_events", "session_days", "session_facts")
    day = f"{LAST_DAY - dt.timedelta(days=20):%Y%m%d}"
    early = export.where((F.col("event_date") != day) | (F.col("batch_ordering_id") % 7 > 1))
    root = _scratch(w, "refreshed")
    for rows in (early, export):
        daily = Warehouse(w.spark, {"events": lambda rows=rows: rows}, w.config, root)
        if rows is early:
            daily.refresh(names)
            for name in names:
                daily.table(name)
            continue
        changed = daily.refresh(names)
        assert set(map(len, changed.values())) == {1}, changed
    return daily.table("session_facts")


def _state_run(name: str, dropped: tuple[str, ...]) -> Callable[[Warehouse], DataFrame]:
    return lambda w: _two_runs(w, _KINDS.get(name, "client_states")).relation(name).drop(*dropped)


# Tables that the incremental models are made from.
_UPSTREAM = (
    "events",
    "articles",
    "accounts",
    "staged_events",
    "session_days",
    "session_traffic_sources",
    "last_non_direct",
    "session_activity",
)


def _plain_columns(df: DataFrame) -> list[str]:
    nested = (T.ArrayType, T.StructType, T.MapType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)]


def _widened_lookback(w: Warehouse) -> DataFrame:
    """Attribution of the window only, from a source read further back."""
    source = w.table("session_traffic_sources")
    path = _scratch(w, "last_non_direct")

    def build(rows: DataFrame) -> DataFrame:
        return sessions.last_non_direct(rows, w.config)

    incremental.rebuild_window(
        build,
        source,
        path,
        source_day="session_partition_date",
        day="session_partition_date",
        as_of=LAST_DAY,
        late_days=w.config.late_days,
        lookback_days=w.config.lookback_days,
    )
    return w.spark.read.schema(build(source).schema).parquet(path)


def _full_rebuild(w: Warehouse) -> DataFrame:
    path = _scratch(w, "paywall_sessions_daily")
    built = w.relation("paywall_sessions_daily")
    incremental.overwrite(built, path, "event_date_dt")
    return w.spark.read.schema(built.schema).parquet(path)


def _scan_from_date(w: Warehouse) -> DataFrame:
    w.table("events")
    export = readers.read_events(w.spark, f"{w.root}/events", "20240120")
    day = F.to_date("event_date", "yyyyMMdd").alias("event_date_dt")
    return export.groupBy(day, "event_name").agg(F.count(F.lit(1)).alias("hits"))


def _parameters(w: Warehouse) -> DataFrame:
    columns = (
        "session_id session_number page_location page_referrer session_engaged engagement_time_msec "
        "page_title event_source event_medium event_campaign event_content event_term"
    ).split()
    value = param(F.col("event_params"), "value", "float").alias("value")
    return _with_row_id(w.relation("base_events"), *columns, value)


def _records(w: Warehouse) -> DataFrame:
    fields = {
        "privacy_info": fixed.PRIVACY_FIELDS,
        "app_info": fixed.APP_FIELDS,
        "user_ltv": fixed.USER_LTV_FIELDS,
        "collected_traffic_source": fixed.COLLECTED_SOURCE_FIELDS,
    }
    columns = [f"{record}_{name}" for record, names in fields.items() for name in names]
    return _with_row_id(w.relation("base_events"), *columns, *clients.EVENT_VALUES)


def _keys(w: Warehouse) -> DataFrame:
    """The keys; of the event key, whose digest of parameters has no counterpart in SQL, how many
    hits have it."""
    names = ("client_key", "session_key", "session_partition_key", "page_key")
    same = F.count(F.lit(1)).over(Window.partitionBy("event_key")).alias("hits_with_event_key")
    engagement = keys.page_engagement_key().alias("page_engagement_key")
    return _with_row_id(w.table("staged_events"), *names, engagement, same)


def _column_names(w: Warehouse) -> DataFrame:
    """Conversions whose names are no column names."""
    renamed = F.when(F.col("event_name") == "share", "4th sign-up").otherwise(F.col("event_name"))
    config = dataclasses.replace(w.config, conversion_events=("newsletter_signup", "4th sign-up"))
    days = sessions.session_days(w.table("staged_events").withColumn("event_name", renamed), config)
    return sessions.session_conversions(days, config)


def _read_back(name: str, reader: Callable[[SparkSession, str], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """A stored input through its reader."""

    def read(w: Warehouse) -> DataFrame:
        w.table(name)
        return reader(w.spark, f"{w.root}/{name}")

    return read


def _source_categories(w: Warehouse) -> DataFrame:
    path = _scratch(w, "source_categories.csv")
    w.table("source_categories").write.mode("overwrite").csv(path, header=True)
    return readers.read_source_categories(w.spark, path)


def _gclid(w: Warehouse) -> DataFrame:
    hits = w.relation("staged_events").filter(F.col("page_location").contains("gclid"))
    return _with_row_id(hits, "event_source", "event_medium", "event_campaign")


def _url_parts(w: Warehouse) -> DataFrame:
    url = F.col("page_location")
    return _with_row_id(
        w.table("staged_events"),
        urls.page_path(url).alias("page_path"),
        urls.page_hostname(url).alias("page_hostname"),
        urls.page_query_string(url).alias("page_query_string"),
        urls.remove_params(url, ["id", "gclid"]).alias("without_ids"),
        urls.remove_params(url, ["*all*"]).alias("without_query"),
        urls.param_value(url, "utm_source").alias("utm_source"),
        *[urls.path_level(url, n).alias(f"level_{n}") for n in (1, 2, 3)],
    )


def _channels(w: Warehouse) -> DataFrame:
    """Distinct campaigns are few, so the rules run after the grouping."""
    campaign = ("event_source", "event_medium", "event_campaign")
    counted = w.table("staged_events").groupBy(*campaign).agg(F.count(F.lit(1)).alias("hits"))
    categories = w.table("source_categories").withColumnRenamed("source", "event_source")
    known = counted.join(categories, "event_source", "left")
    channel = channels.default_channel(
        F.col("event_source"), F.col("event_medium"), F.col("source_category"), F.col("event_campaign")
    )
    return known.select(*campaign, "source_category", channel.alias("channel"), "hits")


def _article_of_hit(w: Warehouse) -> DataFrame:
    pairs = F.col("event_params")
    article, item = param(pairs, "article_id"), param(pairs, "item_id")
    number = articles.event_article(F.col("event_name"), article, item, F.col("page_location"))
    hits = w.table("staged_events").filter(F.col("event_name").isin(*fixed.ARTICLE_EVENTS))
    return _with_row_id(hits, number.alias("article_id")).filter("article_id is not null")


def _reader_of_hit(w: Warehouse) -> DataFrame:
    pairs = F.col("event_params")
    article, item = param(pairs, "article_id"), param(pairs, "item_id")
    number = articles.event_article(F.col("event_name"), article, item, F.col("page_location"))
    hits = w.table("staged_events").filter(
        F.col("event_name").isin(*fixed.ARTICLE_EVENTS) & number.isNotNull()
    )
    people = w.table("accounts").select(
        "user_id", "subscription_date", "churn_date", "subscription_tier", F.lit(True).alias("known")
    )
    read = lookup(
        _with_row_id(hits, "user_id", "event_date_dt"), people, "user_id", ["row_id"]
    )
    day, known = F.col("event_date_dt"), F.col("known")
    dates = F.col("subscription_date"), F.col("churn_date")
    return read.select(
        "row_id",
        reader_type(day, known, *dates).alias("reader_type"),
        reader_tier(day, known, *dates, F.col("subscription_tier")).alias("subscription_tier"),
    )


def _base_events(w: Warehouse) -> DataFrame:
    columns = (
        "event_timestamp event_name user_id user_pseudo_id stream_id event_date_dt session_id is_page_view "
        "is_purchase property_id"
    ).split()
    return _with_row_id(w.relation("base_events"), *columns)


def _staged_events(w: Warehouse) -> DataFrame:
    columns = (
        "event_timestamp session_id session_number event_date_dt event_name client_key session_key "
        "session_partition_key user_id page_location page_referrer page_path page_hostname page_query_string "
        "page_key event_source event_medium event_campaign event_content event_term"
    ).split()
    return _with_row_id(w.relation("staged_events"), *columns)


def _sessionise(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = derived.driver_events(spark, sf_dir)
    visits = sessionise(hits, "user_id", "micros", tie_breakers=["event_id"])
    return plain(visits.select("event_id", "user_id", "session_number"))


def _last_non_direct_30_days(w: Warehouse) -> DataFrame:
    return sessions.last_non_direct(w.table("session_traffic_sources"), EngineConfig(lookback_days=30))


def _wall_policy(w: Warehouse) -> DataFrame:
    reads = articles.wall_policy(
        w.event_type("page_view"), w.table("articles"), w.table("accounts"), SECTION_WALLS
    )
    return reads.drop("event_key")


def _journey(w: Warehouse) -> DataFrame:
    return w.relation("journeys")


def _touches(w: Warehouse) -> DataFrame:
    return subscriptions.touch_points(_journey(w))


def _prior_walls(w: Warehouse) -> DataFrame:
    journey = _journey(w)
    purchases = subscriptions.purchase_sessions(subscriptions.touch_points(journey))
    return subscriptions.prior_walls(journey, purchases)


def _conversion_flags(w: Warehouse) -> DataFrame:
    return w.relation("subscription_rows").select(
        "user_id",
        "purchased_same_day",
        "converted_on_first_wall_session",
        "days_first_wall_to_sub",
        "days_last_read_before_subscription",
    )


def _cube_measures(cube: str) -> Callable[[Warehouse], DataFrame]:
    members = [f"{cube}.{m}" for m in CUBES[cube].measures]
    return lambda w: metric_query(w, MetricQuery(members))


def _cube_dimensions(cube: str) -> Callable[[Warehouse], DataFrame]:
    measure = f"{cube}.{next(iter(CUBES[cube].measures))}"
    members = [f"{cube}.{d}" for d in CUBES[cube].dimensions]
    return lambda w: metric_query(w, MetricQuery([measure], members))


def _metric_query(w: Warehouse) -> DataFrame:
    query = MetricQuery(
        ["traffic.sessions", "traffic.pageviews"],
        ["traffic.channelGrouping", "traffic.trafficSource"],
        "traffic.eventDate",
        grain="month",
        order_by="traffic.sessions",
        limit=5,
    )
    return metric_query(w, query, RANGE)


def _total(w: Warehouse) -> DataFrame:
    members = [f"events.{m}" for m in CUBES["events"].measures]
    return metrics.total(w, MetricQuery(members, time_dimension="events.eventDate"), RANGE)


def _trend(w: Warehouse) -> DataFrame:
    series = {"sessions.sessions": "Sessions", "sessions.pageviews": "Pageviews"}
    grain = metrics.grain_for(WIDE_RANGE)
    query = MetricQuery(list(series), time_dimension="sessions.eventDate", grain=grain)
    return metrics.trend(w, query, series, WIDE_RANGE)


def _breakdown(w: Warehouse) -> DataFrame:
    query = MetricQuery(["sessions.pageviews"], ["sessions.landingPage"], "sessions.eventDate")
    return metrics.breakdown(w, query, "sessions.landingPage", "sessions.pageviews", RANGE, 8)


def _breakdown_multi(w: Warehouse) -> DataFrame:
    series = {
        "traffic.sessions": "Sessions",
        "traffic.pageviews": "Pageviews",
        "traffic.newsletterSignups": "Signups",
    }
    query = MetricQuery(list(series), ["traffic.utmCampaign"], "traffic.eventDate")
    return metrics.breakdown_multi(w, query, "traffic.utmCampaign", series, RANGE)


def _merge_trends(w: Warehouse) -> DataFrame:
    parts = [
        metrics.trend(
            w,
            MetricQuery([measure], time_dimension=day, grain=metrics.grain_for(RANGE)),
            {measure: name},
            RANGE,
        )
        for measure, day, name in (
            ("crm.newSubscribers", "crm.subscriptionDate", "New"),
            ("crm.newChurns", "crm.churnDate", "Churned"),
        )
    ]
    return metrics.merge_trends(parts)


def _period_change(w: Warehouse) -> DataFrame:
    members = ["sessions.sessions", "sessions.activeUsers", "sessions.pageviews"]
    query = MetricQuery(members, time_dimension="sessions.eventDate")
    return metrics.period_change(w, query, CURRENT_RANGE, PREVIOUS_RANGE)


def _event_state(w: Warehouse) -> DataFrame:
    state = CUBES["events"].relation(w)
    active = articles.active_subscription(
        F.col("event_date"), F.col("crm_subscription_date"), F.col("crm_churn_date")
    )
    return state.groupBy("event_date", "event_name").agg(
        F.sum("hits").alias("hits"),
        F.sum(F.when(active, F.col("hits")).otherwise(0)).alias("active_hits"),
        F.sum(F.when(F.col("registered"), F.col("hits")).otherwise(0)).alias("account_hits"),
    )


def _control_totals(w: Warehouse) -> DataFrame:
    """Totals of the cubes against counts of the hits, accounts and articles themselves."""
    export, hits = w.table("events"), w.table("staged_events")
    people, content = w.table("accounts"), w.table("articles")
    name, known = F.col("event_name"), F.col("session_key").isNotNull()
    viewed, shown = name == "page_view", name == "paywall_impression"
    last_day = hits.agg(F.max("event_date_dt")).scalar()
    walls = F.count_if(shown).cast("double"), F.count_if(name == "paywall_click").cast("double")
    of_article = param(F.col("event_params"), "article_id").try_cast("int").isNotNull()
    exposed = hits.where(shown & F.col("session_partition_key").isNotNull())
    exposed_days = exposed.select("event_date_dt").distinct()
    started = people.join(exposed_days, people["subscription_date"] == exposed_days["event_date_dt"], "left_semi")
    in_cms = articles.article_hits(hits.where(viewed)).join(
        content.select(F.col("article_id").alias("number")), F.col("article_id") == F.col("number"), "left_semi"
    )

    def distinct(rows: DataFrame, column: str):
        return rows.agg(F.countDistinct(column)).scalar()

    def filled(rows: DataFrame, column: str):
        return rows.agg(F.count(column)).scalar()

    def until(column: str):
        return people.where(F.col(column) <= last_day).agg(F.count(F.lit(1))).scalar()

    expected = {
        "events": {
            "eventsCount": distinct(export, "batch_ordering_id"),
            "activeUsers": distinct(export, "user_pseudo_id"),
            "activeRegisteredUsers": distinct(export, "user_id"),
        },
        "sessions": {
            "sessions": distinct(hits, "session_key"),
            "activeUsers": distinct(hits, "client_key"),
            "pageviews": filled(hits.where(viewed & known), "event_name"),
        },
        "pages": {"pageviews": filled(hits.where(viewed), "event_name")},
        "paywall": {
            "impressions": hits.where(of_article).agg(walls[0]).scalar(),
            "clicks": hits.where(of_article).agg(walls[1]).scalar(),
            "ctr": hits.where(of_article).agg(walls[1] / walls[0]).scalar(),
        },
        "paywallFunnel": {
            "sessionsExposed": distinct(exposed, "session_partition_key"),
            "newSubscribers": filled(started, "user_id"),
            "paywallConversionRate": filled(started, "user_id").cast("double")
            / distinct(exposed, "session_partition_key"),
        },
        "crm": {
            "newRegisteredUsers": filled(people, "registration_date"),
            "newSubscribers": filled(people, "subscription_date"),
            "newChurns": filled(people, "churn_date"),
        },
        "crmTotals": {
            "numberOfRegisteredUsers": until("registration_date"),
            "cumulativeSubscribers": until("subscription_date"),
            "cumulativeChurns": until("churn_date"),
            "numberOfSubscribers": until("subscription_date") - until("churn_date"),
        },
        "subscriptions": {"newSubscribers": filled(people, "subscription_date")},
        "content": {"articlesPublished": filled(content, "article_id")},
        "contentTotals": {
            "numberOfArticles": content.where(F.col("published_at") <= last_day.cast("timestamp"))
            .agg(F.count(F.lit(1)))
            .scalar()
        },
        "articles": {"articlePageviews": filled(in_cms, "article_id")},
    }
    parts = [
        quality.control_totals(
            metric_query(w, MetricQuery([f"{cube}.{m}" for m in totals])), totals
        ).withColumn("check", F.concat(F.lit(f"{cube}."), "check"))
        for cube, totals in expected.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _reconciliation(w: Warehouse) -> DataFrame:
    pages_total = w.table("pages").agg(F.sum("page_views"))
    visits_total = w.relation("session_facts").agg(F.sum("session_partition_count_page_views"))
    unnamed = w.event_type("page_view").agg(F.count_if(F.col("session_key").isNull()))
    return quality.reconciliation("pages and sessions", pages_total, visits_total, unnamed)


_OVER_WAREHOUSE: dict[str, Callable[[Warehouse], DataFrame]] = {
    "i01_late_window_rebuild": _late_window_rebuild,
    **{f"i01_{name}": _daily_run(name) for name in INCREMENTAL},
    "i01_changed_days": _changed_days,
    "i01_session_conversions": lambda w: sessions.session_conversions(
        _daily_run("session_conversions_daily")(w), w.config
    ),
    **{f"i01_{name}": _state_run(name, dropped) for name, dropped in STATES.items()},
    "i02_scan_from_date": _scan_from_date,
    "i03_articles": _read_back("articles", readers.read_articles),
    "i04_accounts": _read_back("accounts", readers.read_accounts),
    "i05_source_categories": _source_categories,
    "i06_full_rebuild": _full_rebuild,
    "i08_widened_lookback": _widened_lookback,
    "p01_parameters": _parameters,
    "p04_records": _records,
    "p10_keys": _keys,
    "p24_column_names": _column_names,
    "p11_gclid_repair": _gclid,
    "p12_url_parts": _url_parts,
    "p19_channels": _channels,
    "p20_article_of_hit": _article_of_hit,
    "p21_reader_of_hit": _reader_of_hit,
    "e00_base_events": _base_events,
    "e01_staged_events": _staged_events,
    "m01_session_traffic_sources": _relation("session_traffic_sources"),
    "m02_last_non_direct": _relation("last_non_direct"),
    "m02_last_non_direct_30_days": _last_non_direct_30_days,
    "m03_session_conversions": _relation("session_conversions"),
    "m04_page_conversions": _relation("page_conversions"),
    "m05_page_engaged_time": _relation("page_engaged_time"),
    "m06_user_id_mapping": _relation("user_id_mapping"),
    "m07_user_properties": _relation("user_properties"),
    "m08_client_first_last_events": _relation("client_first_last_events", "first_event", "last_event"),
    "m09_client_first_last_page_views": _relation(
        "client_first_last_page_views", "first_page_view_event_key", "last_page_view_event_key"
    ),
    "m10_session_dimension": _relation("session_dimension"),
    "m11_session_facts_daily": _relation("session_facts"),
    "m12_session_facts": _relation("sessions"),
    "m13_client_facts": _relation("client_facts"),
    "m14_user_facts": _relation("user_facts"),
    "m15_client_dimension": _relation("client_dimension", "first_event", "last_event"),
    "m16_pages": _relation("pages"),
    "m17_articles_daily": _relation("articles_daily"),
    "m18_articles_by_reader_type": _relation("articles_by_reader_type"),
    "m19_paywall_daily": _relation("paywall_daily"),
    "m20_paywall_sessions_daily": _relation("paywall_sessions_daily"),
    "m21_traffic_sources_daily": _relation("traffic_sources_daily"),
    "m22_subscription_last_touch": _relation("subscription_last_touch"),
    "m22a_subscribers": lambda w: subscriptions.subscribers(w.table("accounts")),
    "m22b_purchase_sessions": lambda w: subscriptions.purchase_sessions(_touches(w)),
    "m22c_last_reads": lambda w: subscriptions.last_reads(_touches(w)),
    "m22d_prior_walls": _prior_walls,
    "m22e_first_walls": lambda w: subscriptions.first_walls(_touches(w)),
    "m22f_journey_medians": lambda w: subscriptions.journey_medians(w.table("subscription_rows")),
    "m22g_conversion_flags": _conversion_flags,
    "m23_wall_policy": _wall_policy,
    "mq01_metric_query": _metric_query,
    "mq03_total": _total,
    "mq04_trend": _trend,
    "mq05_breakdown": _breakdown,
    "mq06_breakdown_multi": _breakdown_multi,
    "mq07_merge_trends": _merge_trends,
    "mq08_period_change": _period_change,
    "mq09_wall_funnel": lambda w: metrics.wall_funnel(w, RANGE),
    "mq10_net_new_subscribers": lambda w: metrics.net_new_subscribers(w, RANGE),
    "mq11_first_wall_share": lambda w: metrics.first_wall_share(w, RANGE),
    "mq12_event_state": _event_state,
    "mq13_paywall_funnel": lambda w: CUBES["paywallFunnel"].relation(w),
    "mq14_crm_totals": lambda w: CUBES["crmTotals"].relation(w),
    "mq15_content_totals": lambda w: CUBES["contentTotals"].relation(w),
    "t01_not_null": lambda w: quality.not_null(w.table("staged_events"), "client_key"),
    "t02_unique": lambda w: quality.unique(
        w.table("session_activity"), F.col("session_partition_key"), "session_partition_key"
    ),
    "t03_unique_combination": lambda w: quality.unique_combination(
        w.table("articles_by_reader_type"), ["event_date_dt", "article_id", "reader_type"]
    ),
    "t04_accepted_values": lambda w: quality.accepted_values(
        w.table("articles_by_reader_type"), "subscription_tier", ["digital-only", "n/a"]
    ),
    "t05_severity_warn": lambda w: quality.not_null(
        w.table("staged_events"), "page_referrer", level="warn"
    ),
    "t06_control_totals": _control_totals,
    "t07_reconciliation": _reconciliation,
    "t08_all_checks": run_checks,
}
_EVENT_TYPE_ORDER = (
    "page_view session_start first_visit user_engagement scroll click file_download video_start video_progress "
    "video_complete view_search_results search share custom_event bookmark comment newsletter_signup "
    "paywall_impression paywall_click"
).split()
# Named queries shown over the wider range, where the grain becomes a week.
_WIDE = {
    "overview.trendQ",
    "subscriptions.subsTrendQ",
    "subscriptions.churnTrendQ",
    "subscriptions.cumulativeQ",
}


def _snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name)


def _named(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: named_query(w, name, WIDE_RANGE if name in _WIDE else RANGE)


def _all() -> dict[str, Callable[[Warehouse], DataFrame]]:
    found = dict(_OVER_WAREHOUSE)
    for number, name in enumerate(_EVENT_TYPE_ORDER, 2):
        found[f"e{number:02d}_{name}"] = _custom_event if name == "custom_event" else _event_type(name)
    for cube in CUBES:
        found[f"cube_{_snake(cube)}_measures"] = _cube_measures(cube)
        found[f"cube_{_snake(cube)}_dimensions"] = _cube_dimensions(cube)
    for number, name in enumerate(NAMED_QUERIES, 1):
        found[f"d{number:02d}_{name.replace('.', '_')}"] = _named(name)
    return found


def _over_folder(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(warehouse(spark, sf_dir)))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {name: _over_folder(build) for name, build in _all().items()}
    found["g01_sessionise"] = _sessionise
    return dict(sorted(found.items()))
