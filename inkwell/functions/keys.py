"""Surrogate keys and the total order of hits (P10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def client_key() -> Column:
    """Device key; null when consent was denied."""
    return F.md5(F.concat("user_pseudo_id", "stream_id"))


def session_key() -> Column:
    return F.md5(F.concat("client_key", F.col("session_id").cast("string")))


def session_partition_key(day: str = "event_date_dt") -> Column:
    """Session-day key."""
    return F.concat("session_key", F.date_format(day, "yyyy-MM-dd"))


def params_digest(pairs: Column) -> Column:
    """Digest of a key/value array that does not depend on the order of its entries."""
    return F.md5(F.to_json(F.sort_array(pairs)))


def event_key() -> Column:
    """Key of a deduplicated hit; never null, as missing parts are skipped."""
    return F.md5(
        F.concat_ws(
            "",
            "client_key",
            F.col("session_id").cast("string"),
            "event_name",
            F.col("event_timestamp").cast("string"),
            "params_digest",
        )
    )


def page_key() -> Column:
    return F.concat(F.date_format("event_date_dt", "yyyy-MM-dd"), "page_location")


def page_engagement_key(page: str = "page_location") -> Column:
    return F.md5(F.concat("session_key", page))


def hit_order() -> Column:
    """Order of hits in time. The batch columns put hits of one moment in the order
    the device sent them; the event key settles what is left, so that every first or
    last row is the same in every run."""
    return F.struct(
        "event_timestamp", "batch_page_id", "batch_ordering_id", "batch_event_index", "event_key"
    )
