"""Flat columns out of the nested records of the export (P4a to P4g)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell import fixed_values as fixed


def _fields(record: str, names: tuple[str, ...], prefix: str | None = None) -> dict[str, Column]:
    prefix = prefix or record.replace(".", "_")
    return {f"{prefix}_{name}": F.col(f"{record}.{name}") for name in names}


def flat_records() -> dict[str, Column]:
    """Every flattened record field, by output column name."""
    columns = _fields("privacy_info", fixed.PRIVACY_FIELDS)
    columns |= _fields("user_ltv", fixed.USER_LTV_FIELDS)
    columns |= _fields("device", fixed.DEVICE_TEXT_FIELDS)
    columns["device_is_limited_ad_tracking"] = F.col("device.is_limited_ad_tracking").cast("boolean")
    columns["device_time_zone_offset_seconds"] = F.col("device.time_zone_offset_seconds").cast("bigint")
    columns |= _fields("device.web_info", fixed.DEVICE_WEB_FIELDS)
    columns |= _fields("geo", fixed.GEO_FIELDS)
    columns |= _fields("app_info", fixed.APP_FIELDS)
    columns["user_campaign"] = F.col("traffic_source.name")
    columns["user_medium"] = F.col("traffic_source.medium")
    columns["user_source"] = F.col("traffic_source.source")
    columns |= _fields("collected_traffic_source", fixed.COLLECTED_SOURCE_FIELDS)
    return columns
