"""Base, staged and per-type events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell import fixed_values as fixed
from inkwell.config import EngineConfig, Parameter
from inkwell.functions import channels, keys, urls
from inkwell.functions.params import param, session_engaged, session_id
from inkwell.functions.readers import export_date, flag, normalise_event_name
from inkwell.functions.records import flat_records
from inkwell.operators.dedup import first_copy

# The sort before the shuffle compares these in turn; the most distinct ones come first.
_IDENTITY = (
    "event_timestamp",
    "params_digest",
    "event_date_dt",
    "stream_id",
    "user_pseudo_id",
    "session_id",
    "event_name",
)
# What tells most hits apart without reading the parameters; copies agree in all of it.
_MARKS = ("event_timestamp", "event_date_dt", "stream_id", "user_pseudo_id", "event_name")
# Most marks of possible copies that are sent to all tasks (some 20 bytes each).
MOST_MARKS = 1_000_000
_STANDARD_PARAMETERS = (
    Parameter("page_location"),
    Parameter("ga_session_number", "int", "session_number"),
    Parameter("engagement_time_msec", "int"),
    Parameter("page_title"),
    Parameter("page_referrer"),
    Parameter("source", "lower_string", "event_source"),
    Parameter("medium", "lower_string", "event_medium"),
    Parameter("campaign", "lower_string", "event_campaign"),
    Parameter("content", "lower_string", "event_content"),
    Parameter("term", "lower_string", "event_term"),
)
_PASSED_ON = (
    "event_timestamp",
    "event_params",
    "event_previous_timestamp",
    "event_value_in_usd",
    "event_bundle_sequence_id",
    "event_server_timestamp_offset",
    "batch_event_index",
    "batch_ordering_id",
    "batch_page_id",
    "is_active_user",
    "user_id",
    "user_pseudo_id",
    "user_properties",
    "user_first_touch_timestamp",
    "stream_id",
    "platform",
    "ecommerce",
    "items",
    "item_params",
)


def parameter_columns(parameters: Sequence[Parameter]) -> dict:
    pairs = F.col("event_params")
    return {p.column: param(pairs, p.key, p.kind) for p in parameters}


def with_shared_marks(
    export: DataFrame, mark: Column, most_marks: int = MOST_MARKS, among: Column | None = None
) -> DataFrame:
    """``export`` with ``_shared``: whether a row's mark is that of other rows too.

    Marks are found in a narrow pass and sent to all tasks. Beyond ``most_marks`` of them none is
    sent, and all rows count as sharing theirs. With ``among``, which is never null, the other rows have
    no mark and share none.
    """
    among = F.lit(True) if among is None else among
    own = F.when(among, mark)
    marks = export.where(among).select(mark.alias("_mark")).groupBy("_mark").agg(F.count("*").alias("_rows"))
    shared = marks.where(F.col("_rows") > 1).select("_mark")
    many = shared.agg(F.count("*") > most_marks).scalar()
    found = export.join(F.broadcast(shared.where(~many)), own == F.col("_mark"), "left")
    return found.withColumn("_shared", F.col("_mark").isNotNull() | (among & many)).drop("_mark")


def base_events(export: DataFrame, config: EngineConfig) -> DataFrame:
    """Flat, typed and deduplicated hits.

    Parameters are read out after the deduplication: the shuffle then carries their
    array once, and not the values found in it as well. Only rows that share their identity with others can
    be copies and are shuffled; all others stay in the task that read them. The identity is looked at, with
    the parameters, where rows share the mark that does without them.
    """
    pairs = F.col("event_params")
    columns = {
        "event_date_dt": export_date(F.col("event_date")),
        "event_name": normalise_event_name(F.col("event_name")),
        **{name: F.col(name) for name in _PASSED_ON},
        **flat_records(),
        "session_id": session_id(pairs),
        "is_page_view": flag(F.col("event_name") == "page_view"),
        "is_purchase": flag(F.col("event_name") == "purchase"),
        "params_digest": keys.params_digest(pairs),
    }
    rows = export.filter(F.col("event_date") >= config.start_date)
    rows = with_shared_marks(rows, F.xxhash64(*[columns[name] for name in _MARKS]))
    rows = with_shared_marks(rows, F.xxhash64(*[columns[name] for name in _IDENTITY]), among=F.col("_shared"))
    flat = [column.alias(name) for name, column in columns.items()]
    order = ("batch_page_id", "batch_ordering_id", "batch_event_index")
    kept = first_copy(
        rows.where("_shared").select(*flat), _IDENTITY, [F.col(name).asc_nulls_last() for name in order]
    )
    hits = rows.where(~F.col("_shared")).select(*flat).union(kept.hint("rebalance", "event_date_dt"))
    return hits.withColumns(
        {
            "property_id": F.lit(config.property_id).cast("bigint"),
            "session_engaged": session_engaged(pairs),
            **parameter_columns(_STANDARD_PARAMETERS),
        }
    )


def staged_events(base: DataFrame, config: EngineConfig) -> DataFrame:
    """Base hits with keys, repaired campaigns and URL parts."""
    location, referrer = F.col("page_location"), F.col("page_referrer")
    repaired = channels.gclid_repair(
        location, F.col("event_source"), F.col("event_medium"), F.col("event_campaign")
    )
    skipped = config.query_parameter_exclusions
    return (
        base.withColumn("client_key", keys.client_key())
        .withColumn("session_key", keys.session_key())
        .withColumns(
            {
                "session_partition_key": keys.session_partition_key(),
                "event_key": keys.event_key(),
                **repaired,
                "original_page_location": location,
                "original_page_referrer": referrer,
                "page_path": urls.page_path(location),
            }
        )
        .withColumns(
            {
                "page_location": urls.remove_params(location, skipped),
                "page_referrer": urls.remove_params(referrer, skipped),
            }
        )
        .withColumns(
            {
                "page_hostname": urls.page_hostname(location),
                "page_query_string": urls.page_query_string(location),
                "page_key": keys.page_key(),
            }
        )
        .drop("params_digest")
    )


def custom_event(
    staged: DataFrame, name: str, parameters: Sequence[Parameter], config: EngineConfig
) -> DataFrame:
    """Hits of one type with the given, the default and the configured parameters."""
    wanted = [*parameters, *config.default_parameters, *config.event_parameters.get(name, ())]
    hits = staged.filter(F.col("event_name") == name)
    return hits.withColumns(parameter_columns(wanted)) if wanted else hits


def event_type(staged: DataFrame, name: str, config: EngineConfig) -> DataFrame:
    """One of the known event types with its own columns."""
    known = [Parameter(*entry) for entry in fixed.EVENT_TYPE_PARAMETERS[name]]
    hits = custom_event(staged, name, known, config)
    if name != "page_view":
        return hits
    levels = {f"pagepath_level_{n}": urls.path_level(F.col("page_location"), n) for n in range(1, 5)}
    return hits.withColumns({**levels, "page_engagement_key": keys.page_engagement_key()})


def events_daily(staged: DataFrame) -> DataFrame:
    """Hits per day, name, client, login and page: what the event metrics count and distinguish."""
    day = F.col("event_date_dt").alias("event_date")
    return staged.groupBy(day, "event_name", "client_key", "user_id", "page_location").agg(
        F.count(F.lit(1)).alias("hits")
    )
