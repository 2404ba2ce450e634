"""Schemas of the inputs. They are always given, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from inkwell import fixed_values as fixed


def _text_fields(names: tuple[str, ...]) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


_VALUE = [
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
    T.StructField("float_value", T.DoubleType()),
    T.StructField("double_value", T.DoubleType()),
]


def _pairs(value_fields: list[T.StructField]) -> T.ArrayType:
    return T.ArrayType(
        T.StructType(
            [T.StructField("key", T.StringType()), T.StructField("value", T.StructType(value_fields))]
        )
    )


PARAMS = _pairs(_VALUE)
USER_PROPERTIES = _pairs([*_VALUE, T.StructField("set_timestamp_micros", T.LongType())])
PRIVACY = T.StructType(_text_fields(fixed.PRIVACY_FIELDS))
USER_LTV = T.StructType(_text_fields(fixed.USER_LTV_FIELDS))
DEVICE = T.StructType(
    [
        *_text_fields(fixed.DEVICE_TEXT_FIELDS),
        T.StructField("is_limited_ad_tracking", T.BooleanType()),
        T.StructField("time_zone_offset_seconds", T.LongType()),
        T.StructField("web_info", T.StructType(_text_fields(fixed.DEVICE_WEB_FIELDS))),
    ]
)
GEO = T.StructType(_text_fields(fixed.GEO_FIELDS))
APP = T.StructType(_text_fields(fixed.APP_FIELDS))
TRAFFIC_SOURCE = T.StructType(_text_fields(("name", "medium", "source")))
COLLECTED_SOURCE = T.StructType(_text_fields(fixed.COLLECTED_SOURCE_FIELDS))

EVENTS = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("event_params", PARAMS),
        T.StructField("event_previous_timestamp", T.LongType()),
        T.StructField("event_value_in_usd", T.DoubleType()),
        T.StructField("event_bundle_sequence_id", T.LongType()),
        T.StructField("event_server_timestamp_offset", T.IntegerType()),
        T.StructField("batch_event_index", T.LongType()),
        T.StructField("batch_ordering_id", T.LongType()),
        T.StructField("batch_page_id", T.LongType()),
        T.StructField("is_active_user", T.BooleanType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("privacy_info", PRIVACY),
        T.StructField("user_properties", USER_PROPERTIES),
        T.StructField("user_first_touch_timestamp", T.LongType()),
        T.StructField("user_ltv", USER_LTV),
        T.StructField("device", DEVICE),
        T.StructField("geo", GEO),
        T.StructField("app_info", APP),
        T.StructField("traffic_source", TRAFFIC_SOURCE),
        T.StructField("stream_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("ecommerce", T.StringType()),
        T.StructField("items", T.StringType()),
        T.StructField("item_params", T.StringType()),
        T.StructField("collected_traffic_source", COLLECTED_SOURCE),
        T.StructField("session_traffic_source_last_click", T.StringType()),
    ]
)

ARTICLES = T.StructType(
    [
        T.StructField("article_id", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("section", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("word_count", T.IntegerType()),
        T.StructField("is_breaking", T.BooleanType()),
        T.StructField("has_video", T.BooleanType()),
    ]
)

ACCOUNTS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("registration_date", T.DateType()),
        T.StructField("country", T.StringType()),
        T.StructField("is_subscriber", T.BooleanType()),
        T.StructField("subscription_tier", T.StringType()),
        T.StructField("subscription_date", T.DateType()),
        T.StructField("churn_date", T.DateType()),
    ]
)

SOURCE_CATEGORIES = T.StructType(
    [T.StructField("source", T.StringType()), T.StructField("source_category", T.StringType())]
)
