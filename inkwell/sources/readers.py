"""Readers (I2 to I5). Files are read with a given schema, so partition values keep
their text type and only the columns and nested fields in use leave the disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.sources import schemas


def read_events(spark: SparkSession, path: str, start_date: str | None = None) -> DataFrame:
    """The event export from ``start_date`` (yyyyMMdd) on; older partitions are not opened."""
    events = spark.read.schema(schemas.EVENTS).parquet(path)
    return events if start_date is None else events.filter(F.col("event_date") >= start_date)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ARTICLES).parquet(path)


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ACCOUNTS).parquet(path)


def read_source_categories(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row: source, source_category."""
    return spark.read.csv(path, header=True, schema=schemas.SOURCE_CATEGORIES)
