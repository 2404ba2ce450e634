"""Table writers: full rebuilds and rebuilds of a window of days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Tables are written once and read often, so they are packed tighter than Spark's default.
CODEC = "zstd"


def window_start(as_of: dt.date, days: int) -> dt.date:
    """First day of a window of ``days`` days before ``as_of``, plus ``as_of`` itself."""
    return as_of - dt.timedelta(days=days)


def in_window(day: str, as_of: dt.date, days: int) -> Column:
    return F.col(day).between(F.lit(window_start(as_of, days)), F.lit(as_of))


def overwrite(df: DataFrame, path: str, partition: str | None = None, dealt: bool = False) -> None:
    """Replace the whole table.

    A partitioned table is rebalanced by its partition first: few files per day, and
    adaptive execution splits the days that are larger than the others. Rows that are ``dealt``
    come by day already and stay where they are.
    """
    if partition is None:
        df.write.mode("overwrite").parquet(path, compression=CODEC)
        return
    rows = df if dealt else df.hint("rebalance", partition)
    rows.write.mode("overwrite").partitionBy(partition).parquet(path, compression=CODEC)


def overwrite_days(df: DataFrame, path: str, partition: str) -> None:
    """Replace only the days that ``df`` has rows for."""
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path, compression=CODEC)
    )


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def replace_days(df: DataFrame, path: str, day: str, days: Sequence[dt.date]) -> None:
    """Replace these days of a table by the rows of ``df``; days that it has no rows for go.

    The rows are computed once, into a table beside, together with the list of days. From then on the
    replacement is under way and :func:`finish` can carry it through, whoever calls it.
    """
    spark, beside = df.sparkSession, _beside(path)
    finish(spark, path, day, df.schema)
    files, folder = _files(spark, beside)
    files.delete(folder, True)
    overwrite(df, beside, day)
    spark.createDataFrame([(d,) for d in days], "day date").coalesce(1).write.parquet(f"{beside}/_days")
    finish(spark, path, day, df.schema)


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}__window"


def finish(spark: SparkSession, path: str, day: str, schema: T.StructType) -> None:
    """Carry through a replacement of days that broke off, if there is one."""
    beside = _beside(path)
    files, done = _files(spark, f"{beside}/_days/_SUCCESS")
    if not files.exists(done):
        return
    days = [r.day for r in spark.read.parquet(f"{beside}/_days").collect()]
    built = spark.read.schema(schema).parquet(beside)
    overwrite_days(built, path, day)
    written = {r[0] for r in built.select(day).distinct().collect()}
    for gone in days:
        if gone not in written:
            files.delete(_files(spark, f"{path}/{day}={gone.isoformat()}")[1], True)
    files.delete(_files(spark, beside)[1], True)


def replace_window(df: DataFrame, path: str, day: str, as_of: dt.date, late_days: int) -> None:
    """Replace the days of a window."""
    replace_days(df, path, day, [as_of - dt.timedelta(days=n) for n in range(late_days + 1)])


def day_digests(rows: DataFrame, day: str) -> DataFrame:
    """(day, rows, digest): what a day's rows are, whatever their order."""
    each = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])))
    return rows.groupBy(F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(each.cast("decimal(38,0)")).alias("digest")
    )


def rebuild_window(
    build: Callable[[DataFrame], DataFrame],
    source: DataFrame,
    path: str,
    *,
    source_day: str,
    day: str,
    as_of: dt.date,
    late_days: int,
    lookback_days: int = 0,
) -> None:
    """Rebuild the days from ``as_of - late_days`` to ``as_of`` of the table at ``path``.

    ``build`` maps source rows to table rows. With a lookback (I8) it reads that many
    more days of the source, but only the window is written. Whole days are replaced,
    so rows whose source is gone disappear as well, and so does a day without any rows. A
    run that broke off is carried through by the next one.
    """
    recent = source.filter(in_window(source_day, as_of, late_days + lookback_days))
    replace_window(build(recent).filter(in_window(day, as_of, late_days)), path, day, as_of, late_days)
