"""Distinct clients and logins over any range of days, from bitmaps that merge.

Every id has a number that it keeps, in a dictionary that runs only add to. A day's ids are bitmaps of
their numbers, each of a bounded size; the distinct ids of a range are the bits of the days' bitmaps put
together, so a query neither reads nor shuffles ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Numbers are dealt out in so many parts, each in the order of its own count.
_PARTS = 64
CLIENTS, LOGINS, VISITORS = "clients", "logins", "visitors"


def _ids(events: DataFrame) -> DataFrame:
    """(kind, id) of the clients and logins of daily event counts."""
    both = F.array(
        F.struct(F.lit("client").alias("kind"), F.col("client_key").alias("id")),
        F.struct(F.lit("login").alias("kind"), F.col("user_id").alias("id")),
    )
    return events.select(F.inline(both)).where(F.col("id").isNotNull()).distinct()


def id_numbers(events: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(kind, id, number) of the ids that are not ``known``. Numbers of a kind are almost without gaps.

    An id's part comes from its hash; within a part ids are counted on from the known ones, so parts
    are numbered side by side.
    """
    part = F.pmod(F.xxhash64("id"), F.lit(_PARTS)).alias("part")
    new = _ids(events)
    if known is not None:
        new = new.join(known, ["kind", "id"], "left_anti")
    ranked = new.select("kind", "id", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("kind", "part").orderBy("id")) - 1
    )
    if known is None:
        return ranked.select("kind", "id", (F.col("rank") * _PARTS + F.col("part")).cast("long").alias("number"))
    taken = known.groupBy("kind", part).agg((F.max("number") - F.col("part")).alias("most"))
    taken = taken.select("kind", "part", (F.col("most") / _PARTS + 1).cast("long").alias("taken"))
    rank = F.col("rank") + F.coalesce("taken", F.lit(0))
    return ranked.join(taken, ["kind", "part"], "left").select(
        "kind", "id", (rank * _PARTS + F.col("part")).cast("long").alias("number")
    )


def activity_bitmaps(events: DataFrame, activity: DataFrame, numbers: DataFrame) -> DataFrame:
    """(event_date, who, bucket, bitmap): who was active on a day, 32768 numbers to a bitmap.

    ``who`` are the clients and logins with hits, and the visitors: clients with a session.
    """
    seen = events.select("event_date", F.lit("client").alias("kind"), F.lit(CLIENTS).alias("who"), F.col("client_key").alias("id"))
    seen = seen.union(events.select("event_date", F.lit("login"), F.lit(LOGINS), "user_id"))
    visits = activity.where(F.col("session_partition_key").isNotNull())
    seen = seen.union(
        visits.select(F.col("session_partition_date"), F.lit("client"), F.lit(VISITORS), F.col("client_key"))
    )
    numbered = seen.where(F.col("id").isNotNull()).distinct().join(numbers, ["kind", "id"])
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return numbered.groupBy("event_date", "who", bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def active(bitmaps: DataFrame, who: Sequence[str], bucket: Column | None = None) -> DataFrame:
    """Distinct ids of each kind in ``who``, one row, or one per value of ``bucket`` (named ``at``)."""
    keys = [] if bucket is None else [bucket.alias("at")]
    merged = (
        bitmaps.where(F.col("who").isin(*who))
        .groupBy(*keys, "who", "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("ids"))
    )
    counts = [F.coalesce(F.sum(F.when(F.col("who") == w, F.col("ids"))), F.lit(0)).cast("long").alias(w) for w in who]
    return merged.groupBy(*([] if bucket is None else ["at"])).agg(*counts)
