"""Client and user relations (M6 to M9, M12 to M15), kept as states that days are added to.

One row per client and day holds what the client relations need of that day's hits, each value with its
place in the order of hits. Rows of several days merge into one of the same shape. Session, client and
user totals advance by signed contributions: what a changed session gave its client before is taken
off and what it gives now is added, and likewise a changed client and its user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell import fixed_values as fixed
from inkwell.config import EngineConfig
from inkwell.functions.keys import hit_order
from inkwell.functions.params import column_name, param
from inkwell.operators.firsts import earliest, newest, unpack
from inkwell.rebuilds.states import Bundle, Keep, Tables

EVENT_VALUES = (
    *[f"geo_{name}" for name in fixed.GEO_FIELDS],
    *[f"device_{name}" for name in fixed.DEVICE_TEXT_FIELDS],
    "device_is_limited_ad_tracking",
    "device_time_zone_offset_seconds",
    *[f"device_web_info_{name}" for name in fixed.DEVICE_WEB_FIELDS],
    "user_campaign",
    "user_medium",
    "user_source",
)
_VIEW_VALUES = ("page_location", "page_hostname", "page_referrer")
_FIRSTS = ("first_event", "first_view")
_LASTS = ("last_event", "last_view")


def _property_states(config: EngineConfig) -> list[str]:
    return [f"property_{p.column}" for p in config.user_properties]


def client_days(staged: DataFrame, config: EngineConfig) -> DataFrame:
    """One row per client and day: first and last hit and page view, newest login and properties.

    All of it comes from one grouping of the day's hits.
    """
    order, pairs = hit_order(), F.col("user_properties")
    viewed = F.col("event_name") == "page_view"
    hit = F.struct(order.alias("at"), "event_key", *EVENT_VALUES)
    view = F.struct(order.alias("at"), "event_key", *_VIEW_VALUES)
    values = {f"property_{p.column}": param(pairs, p.key, p.kind) for p in config.user_properties}
    login = F.struct(F.col("event_timestamp").alias("at"), "user_id")
    known = staged.filter(F.col("client_key").isNotNull()).withColumns({f"_{n}": v for n, v in values.items()})
    return known.groupBy("client_key", "event_date_dt").agg(
        F.max("stream_id").alias("stream_id"),
        earliest(hit, order).alias("first_event"),
        newest(hit, order).alias("last_event"),
        earliest(view, order, viewed).alias("first_view"),
        newest(view, order, viewed).alias("last_view"),
        F.max(F.when(F.col("user_id").isNotNull(), login)).alias("login"),
        *[
            newest(F.struct(order.alias("at"), F.col(f"_{n}").alias("value")), order, F.col(f"_{n}").isNotNull()).alias(n)
            for n in values
        ],
    )


def merged(states: DataFrame, config: EngineConfig) -> DataFrame:
    """One state per client from any number of them. The order in which states are merged does not matter."""
    return states.groupBy("client_key").agg(
        F.max("stream_id").alias("stream_id"),
        *[earliest(F.col(n), F.col(f"{n}.at")).alias(n) for n in _FIRSTS],
        *[newest(F.col(n), F.col(f"{n}.at")).alias(n) for n in _LASTS],
        F.max("login").alias("login"),
        *[newest(F.col(n), F.col(f"{n}.at")).alias(n) for n in _property_states(config)],
    )


def client_states(config: EngineConfig) -> Bundle:
    def advance(state: Tables | None, days: Tables, keep: Keep) -> Tables:
        rows = days["client_days"].drop("event_date_dt")
        if state:
            rows = rows.unionByName(state["client_states"])
        return {"client_states": merged(rows, config)}

    return Bundle(("client_states",), ("client_days",), advance)


def user_id_mapping(states: DataFrame) -> DataFrame:
    """Login last seen on each client (M6)."""
    return states.filter(F.col("login").isNotNull()).select(
        F.col("login.user_id").alias("last_seen_user_id"),
        "client_key",
        F.col("login.at").alias("last_seen_user_id_timestamp"),
    )


def _properties(config: EngineConfig) -> list[Column]:
    return [F.col(f"property_{p.column}.value").alias(p.column) for p in config.user_properties]


def user_properties(states: DataFrame, config: EngineConfig) -> DataFrame:
    """Newest non-null value of each configured property (M7)."""
    return states.select("client_key", *_properties(config))


def client_first_last_events(states: DataFrame) -> DataFrame:
    """Place, device and campaign of the first and last hit of each client (M8)."""
    return states.select(*_events())


def _events() -> list[Column]:
    return [
        F.col("client_key"),
        F.col("first_event.event_key").alias("first_event"),
        F.col("last_event.event_key").alias("last_event"),
        F.col("stream_id"),
        *unpack("first_event", {name: f"first_{name}" for name in EVENT_VALUES}),
        *unpack("last_event", {name: f"last_{name}" for name in EVENT_VALUES}),
    ]


def _views() -> list[Column]:
    return [
        *unpack("first_view", {name: f"first_{name}" for name in _VIEW_VALUES}),
        *unpack("last_view", {name: f"last_{name}" for name in _VIEW_VALUES}),
    ]


def client_first_last_page_views(states: DataFrame) -> DataFrame:
    """First and last page view of each client that has one (M9)."""
    return states.filter(F.col("first_view").isNotNull()).select(
        "client_key",
        F.col("first_view.event_key").alias("first_page_view_event_key"),
        F.col("last_view.event_key").alias("last_page_view_event_key"),
        *_views(),
    )


def client_dimension(states: DataFrame, config: EngineConfig) -> DataFrame:
    """Descriptive columns of each client (M15). One state has them all, so nothing is joined."""
    return states.select(*_events(), *_views(), *_properties(config))


# Totals of sessions, clients and users

_EXACT = "decimal(38,12)"  # sums of money can be taken off again without a remainder


def _conversions(config: EngineConfig) -> list[str]:
    return [column_name(name) for name in config.conversion_events]


def _sums(config: EngineConfig) -> list[str]:
    """Totals of clients and users that add up."""
    return [
        "count_pageviews",
        "count_engaged_sessions",
        "sum_event_value_in_usd",
        "sum_engaged_time_msec",
        "count_sessions",
        *[f"count_{name}" for name in _conversions(config)],
    ]


# Sums that are null where no value went in, so the values in them are counted.
_MAY_BE_NULL = ("sum_event_value_in_usd", "sum_engaged_time_msec")
_SESSION = ("client_key", "session_key", "stream_id")
_CLIENT = ("client_key", "stream_id")
_USER = ("user_id_or_client_key", "stream_id")


def _session_states(facts: DataFrame, config: EngineConfig) -> DataFrame:
    """Session-days in the shape of session totals."""
    return facts.select(
        *_SESSION,
        "user_id",
        F.col("session_partition_min_timestamp").alias("session_start_timestamp"),
        F.col("session_partition_date").alias("session_start_date"),
        F.col("session_partition_count_page_views").alias("count_pageviews"),
        F.col("session_partition_sum_event_value_in_usd").cast(_EXACT).alias("sum_event_value_in_usd"),
        F.col("session_partition_max_session_engaged").alias("is_session_engaged"),
        F.col("session_partition_sum_engagement_time_msec").alias("sum_engaged_time_msec"),
        "session_number",
        *[F.col(f"{name}_count").alias(f"count_{name}") for name in _conversions(config)],
    )


def _merged_sessions(states: DataFrame, config: EngineConfig) -> DataFrame:
    sums = ["sum_engaged_time_msec", *[f"count_{name}" for name in _conversions(config)]]
    return states.groupBy(*_SESSION).agg(
        F.max("user_id").alias("user_id"),
        F.min("session_start_timestamp").alias("session_start_timestamp"),
        F.min("session_start_date").alias("session_start_date"),
        F.sum("count_pageviews").alias("count_pageviews"),
        F.sum("sum_event_value_in_usd").cast(_EXACT).alias("sum_event_value_in_usd"),
        F.max("is_session_engaged").alias("is_session_engaged"),
        *[F.sum(name).alias(name) for name in sums[:1]],
        F.min("session_number").alias("session_number"),
        *[F.sum(name).alias(name) for name in sums[1:]],
    )


def _signed(rows: DataFrame, names: list[str], sign: int, *others: Column) -> DataFrame:
    """Contributions: each value times the sign, and whether there was one where it may be missing.

    The earliest moments count for what is added only; taking off never makes them earlier.
    """
    first = [
        F.when(F.lit(sign > 0), F.col(n)).alias(n) for n in ("first_seen_timestamp", "first_seen_start_date")
    ]
    plus = {n: F.coalesce(F.col(n), F.lit(0)) for n in names}
    values = [(v if sign > 0 else -v).alias(n) for n, v in plus.items()]
    counts = [
        (F.col(f"n_{n}") if f"n_{n}" in rows.columns else F.col(n).isNotNull().cast("bigint")) * sign
        for n in _MAY_BE_NULL
    ]
    return rows.select(*others, *first, *values, *[c.alias(f"n_{n}") for c, n in zip(counts, _MAY_BE_NULL, strict=True)])


def _added(rows: DataFrame, keys: tuple[str, ...], names: list[str], *others: Column) -> DataFrame:
    """The sum of contributions by key."""
    sums = [
        F.sum(n).cast(_EXACT if n == "sum_event_value_in_usd" else "bigint").alias(n)
        for n in (*names, *[f"n_{n}" for n in _MAY_BE_NULL])
    ]
    first = [F.min(n).alias(n) for n in ("first_seen_timestamp", "first_seen_start_date")]
    return rows.groupBy(*keys).agg(*first, *sums, *others)


def _by_client(sessions: DataFrame, config: EngineConfig, sign: int) -> DataFrame:
    named = sessions.withColumns(
        {
            "first_seen_timestamp": F.col("session_start_timestamp"),
            "first_seen_start_date": F.col("session_start_date"),
            "count_engaged_sessions": F.col("is_session_engaged").cast("bigint"),
            "count_sessions": F.lit(1).cast("bigint"),
        }
    )
    return _signed(named, _sums(config), sign, *[F.col(n) for n in _CLIENT])


def _by_user(clients: DataFrame, config: EngineConfig, sign: int) -> DataFrame:
    login = F.col("login.user_id")
    return _signed(
        clients, _sums(config), sign, F.coalesce(login, F.col("client_key")).alias(_USER[0]), F.col("stream_id"),
        (login.isNotNull().cast("bigint") * sign).alias("logins"), F.lit(sign).cast("bigint").alias("clients"),
    )


def totals(config: EngineConfig) -> Bundle:
    """Session, client and user totals."""
    names = _sums(config)

    def advance(state: Tables | None, days: Tables, keep: Keep) -> Tables:
        # Sessions that the days touch, as they were (off) and as they are now (on).
        new = _merged_sessions(_session_states(days["session_facts"], config), config)
        logins = days["client_days"].groupBy("client_key").agg(F.max("login").alias("new_login"))
        if not state:
            on = _added(_by_client(new, config, 1), _CLIENT, names).join(logins, "client_key", "left")
            clients = on.withColumnRenamed("new_login", "login")
            users = _users(_by_user(clients, config, 1))
            return {"session_totals": new, "client_totals": clients, "user_totals": users}

        sessions0, clients0, users0 = (state[n] for n in ("session_totals", "client_totals", "user_totals"))
        new = keep(new, "sessions_of_days")
        same = [new[k].eqNullSafe(sessions0[k]) for k in _SESSION]
        off = keep(sessions0.join(new.select(*_SESSION), same, "left_semi"), "sessions_before")
        on = keep(_merged_sessions(new.unionByName(off), config), "sessions_after")
        sessions1 = sessions0.join(new.select(*_SESSION), same, "left_anti").unionByName(on)

        # Each client that the days touch loses what its sessions gave before and gets what they give now.
        change = _by_client(on, config, 1).unionByName(_by_client(off, config, -1))
        touched = logins.join(on.select("client_key").distinct(), "client_key", "full")
        touched = keep(touched, "clients_of_days")
        before = keep(clients0.join(touched.select("client_key"), "client_key", "left_semi"), "clients_before")
        sums = _added(change.unionByName(before.select(*change.columns)), _CLIENT, names)
        known = before.groupBy("client_key").agg(F.max("login").alias("old_login"))
        now = sums.join(touched, "client_key", "left").join(known, "client_key", "left")
        after = keep(
            now.withColumn("login", F.greatest("old_login", "new_login")).select(*clients0.columns), "clients_after"
        )
        clients1 = clients0.join(touched.select("client_key"), "client_key", "left_anti").unionByName(after)

        # The same for their users. A user that a client left may have had its first moment from it.
        signed = _by_user(after, config, 1).unionByName(_by_user(before, config, -1))
        left = before.join(
            after.select(F.col("client_key").alias("_key"), F.col("stream_id").alias("_stream"), F.col("login").alias("_login")),
            (F.col("client_key") == F.col("_key")) & F.col("stream_id").eqNullSafe(F.col("_stream")),
        ).where(~F.col("login.user_id").eqNullSafe(F.col("_login.user_id")))
        left = left.select(F.coalesce("login.user_id", "client_key").alias(_USER[0]), "stream_id").distinct()
        left = keep(left, "users_left")
        added = _users(signed.unionByName(users0.select(*signed.columns)))
        remaining = _by_user(clients1, config, 1)
        again = _matching(remaining, left, "left_semi")
        again = again.groupBy(*_USER).agg(
            F.min("first_seen_timestamp").alias("_first"), F.min("first_seen_start_date").alias("_day")
        )
        again = again.select(F.col(_USER[0]).alias("_user"), F.col("stream_id").alias("_stream"), "_first", "_day")
        met = (F.col(_USER[0]) == F.col("_user")) & F.col("stream_id").eqNullSafe(F.col("_stream"))
        users1 = added.where("clients > 0").join(again, met, "left")
        users1 = users1.withColumns(
            {
                "first_seen_timestamp": F.coalesce("_first", "first_seen_timestamp"),
                "first_seen_start_date": F.coalesce("_day", "first_seen_start_date"),
            }
        ).select(*users0.columns)
        return {"session_totals": sessions1, "client_totals": clients1, "user_totals": users1}

    def _users(rows: DataFrame) -> DataFrame:
        counted = [F.sum(n).alias(n) for n in ("logins", "clients")]
        return _added(rows, _USER, names, *counted)

    def _matching(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(*[F.col(k).alias(f"_{k}") for k in _USER])
        return rows.join(keys, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in _USER], how)

    return Bundle(("session_totals", "client_totals", "user_totals"), ("session_facts", "client_days"), advance)


def _shown(totals: DataFrame, names: list[str]) -> list[Column]:
    columns = []
    for n in names:
        value = F.col(n).cast("double") if n == "sum_event_value_in_usd" else F.col(n)
        if f"n_{n}" in totals.columns:
            value = F.when(F.col(f"n_{n}") > 0, value)
        columns.append(value.alias(n))
    return columns


def sessions(totals: DataFrame) -> DataFrame:
    """Metrics of whole sessions."""
    return totals.withColumn("sum_event_value_in_usd", F.col("sum_event_value_in_usd").cast("double"))


def client_facts(totals: DataFrame, config: EngineConfig) -> DataFrame:
    """Metrics of each client."""
    return totals.select(
        *_CLIENT, "first_seen_timestamp", "first_seen_start_date", *_shown(totals, _sums(config))
    )


def user_facts(totals: DataFrame, config: EngineConfig) -> DataFrame:
    """Metrics of each login, or of the client where no login was seen."""
    login = F.when(F.col("logins") > 0, 1).otherwise(0).alias("is_user_id")
    return totals.select(
        *_USER, login, "first_seen_timestamp", "first_seen_start_date", *_shown(totals, _sums(config))
    )
