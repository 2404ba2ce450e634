"""Small hand-made inputs in the shape of the export."""

from __future__ import annotations

import datetime as dt
import itertools

from pyspark.sql import DataFrame, SparkSession

from inkwell.config import EngineConfig
from inkwell.plans import staging
from inkwell.plans.warehouse import Warehouse
from inkwell.sources import schemas

_numbers = itertools.count(1)
SECOND = 1_000_000
DAY = 86_400 * SECOND


def micros(text: str) -> int:
    moment = dt.datetime.fromisoformat(text).replace(tzinfo=dt.UTC)
    return int(moment.timestamp()) * SECOND + moment.microsecond


def pair(key: str, value) -> dict:
    field = {str: "string_value", int: "int_value", float: "float_value"}[type(value)]
    return {"key": key, "value": {field: value}}


def hit(name: str, at: str | int, *, client: str | None = "c1", session=1, properties=None, **values) -> dict:
    """One export row. Keywords are columns of the export, or else event parameters."""
    when = micros(at) if isinstance(at, str) else at
    columns = {f.name for f in schemas.EVENTS.fields}
    params = {"ga_session_id": session, "ga_session_number": 1}
    params |= {k: v for k, v in values.items() if k not in columns}
    row = dict.fromkeys(columns)
    row |= {k: v for k, v in values.items() if k in columns}
    return row | {
        "event_date": dt.datetime.fromtimestamp(when // SECOND, dt.UTC).strftime("%Y%m%d"),
        "event_timestamp": when,
        "event_name": name,
        "event_params": [pair(k, v) for k, v in params.items() if v is not None],
        "user_properties": [pair(k, v) for k, v in (properties or {}).items()],
        "user_pseudo_id": client,
        "stream_id": row["stream_id"] or "s",
        "platform": "web",
        "batch_ordering_id": next(_numbers),
    }


def export(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame(rows, schemas.EVENTS)


def staged(spark: SparkSession, rows: list[dict], config: EngineConfig | None = None) -> DataFrame:
    config = config or EngineConfig()
    return staging.staged_events(staging.base_events(export(spark, rows), config), config)


def article(number: int, **values) -> dict:
    row = {
        "article_id": number,
        "title": f"T{number}",
        "section": "politics",
        "author": "a",
        "published_at": dt.datetime(2024, 1, 1),
        "word_count": 10,
        "is_breaking": False,
        "has_video": False,
    }
    return row | values


def account(user: str, **values) -> dict:
    row = {
        "user_id": user,
        "user_pseudo_id": f"c-{user}",
        "registration_date": dt.date(2024, 1, 1),
        "country": "US",
        "is_subscriber": False,
        "subscription_tier": None,
        "subscription_date": None,
        "churn_date": None,
    }
    return row | values


def warehouse(spark, tmp_path, hits, articles=(), accounts=(), categories=(), config=None) -> Warehouse:
    inputs = {
        "events": lambda: export(spark, list(hits)),
        "articles": lambda: spark.createDataFrame(list(articles), schemas.ARTICLES),
        "accounts": lambda: spark.createDataFrame(list(accounts), schemas.ACCOUNTS),
        "source_categories": lambda: spark.createDataFrame(list(categories), schemas.SOURCE_CATEGORIES),
    }
    return Warehouse(spark, inputs, config or EngineConfig(), str(tmp_path))
