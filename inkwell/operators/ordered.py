"""Running values along time that do not need a whole key in one task.

A plain window sorts everything one client ever did in a single task, which fails
when one client holds a large share of the rows. Here the rows of a key are cut into
time buckets, and a bucket that holds many rows is cut further into slices. A window
runs inside each slice; its last row then has the state that the slice adds. A second
window over these few states carries them from slice to slice. Results are the same as
those of one window per key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.joins import MOST_KEYS

DAY_MICROS = 24 * 60 * 60 * 1_000_000
# A bucket with more rows than this, and than one row in MOST_KEYS, is cut further.
SLICE_ROWS = 500_000
_NO_BUCKET = -(2**31)  # of rows without a moment; they come first


def day_bucket(micros: str | Column) -> Column:
    column = F.col(micros) if isinstance(micros, str) else micros
    return F.floor(column / DAY_MICROS).cast("int")


def slice_starts(df: DataFrame, keys: Sequence[str], at: str, rows: int = SLICE_ROWS) -> DataFrame | None:
    """Where the buckets (``_bucket``) that hold too many rows are cut: (keys, _bucket, _starts).

    Counts choose the buckets, fewer than ``MOST_KEYS`` of them whatever the number of rows, and
    quantiles of the order column the cuts, so slices have about as many rows. Rows of one moment stay
    together. None if no bucket needs it. This runs a job that reads the keys and the order column.
    """
    grain = [*keys, "_bucket"]
    counts = df.groupBy(*grain).agg(F.count("*").alias("_rows"))
    limit = counts.agg(F.greatest(F.sum("_rows") / MOST_KEYS, F.lit(rows))).scalar()
    heavy = counts.where(F.col("_rows") > limit).select(*grain, "_rows", limit.alias("_limit")).collect()
    if not heavy:
        return None
    spark = df.sparkSession
    most = min(10_000, max(math.ceil(r["_rows"] / r["_limit"]) for r in heavy))
    names = df.select(*grain).schema
    chosen = spark.createDataFrame(
        [(*r[:-2], max(1, most * int(r["_limit"]) // r["_rows"])) for r in heavy],
        names.add("_step", "long"),
    )
    points = [n / most for n in range(1, most)] or [0.5]
    cuts = (
        df.join(F.broadcast(chosen), grain)
        .groupBy(*grain, "_step")
        .agg(F.percentile_approx(at, points, 100_000).alias("_points"))
    )
    kept = F.array_distinct(F.filter("_points", lambda _, i: (i + 1) % F.col("_step") == 0))
    found = cuts.select(*grain, kept.alias("_starts"))
    return spark.createDataFrame(found.collect(), found.schema)


def running(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    *,
    latest_before: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    greatest: Mapping[str, Column] | None = None,
    total: Mapping[str, Column] | None = None,
    pause: int | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add running columns per ``keys``, in the order of ``order``, whose first column is a number.

    ``latest_before`` and ``latest`` give the newest non-null value before or up to the
    row, ``greatest`` the largest value up to the row with rows of equal order included
    (``order`` is then one column), ``total`` the sum up to the row. ``bucket``, an int, must
    not fall when ``order`` rises. Rows with a null key are left out.

    With ``pause``, a visit ends where the first order column rises by more than it, and
    ``session_number``, ``session_first_micros`` and ``opens_session`` are added.
    """
    latest_before, latest = dict(latest_before or {}), dict(latest or {})
    greatest, total = dict(greatest or {}), dict(total or {})
    at = order[0]
    # Neither is null, so the join below asks nothing more of one branch than of the other.
    known = [F.col(k).isNotNull() for k in keys]
    tagged = df.where(reduce(Column.__and__, known)).withColumn("_bucket", F.coalesce(bucket, F.lit(_NO_BUCKET)))
    starts = slice_starts(tagged, keys, at, slice_rows)
    number = F.lit(0)
    if starts is not None:
        tagged = tagged.join(F.broadcast(starts), [*keys, "_bucket"], "left")
        number = F.coalesce(F.size(F.filter("_starts", lambda s: s <= F.col(at))), F.lit(0))
        number = F.when(F.col("_starts").isNull(), 0).otherwise(number)
    tagged = tagged.withColumn("_slice", number).select(*df.columns, "_bucket", "_slice")

    slice_ = [*keys, "_bucket", "_slice"]
    ordered = Window.partitionBy(*slice_).orderBy(*order)
    up_to = ordered.rowsBetween(Window.unboundedPreceding, 0)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    with_peers = ordered.rangeBetween(Window.unboundedPreceding, 0)

    # The value of the row, where it differs from what the slice has up to the row, and that.
    row = {f"_row_{n}": F.last(v, ignorenulls=True).over(before) for n, v in latest_before.items()}
    own = {n: F.last(v, ignorenulls=True).over(up_to) for n, v in (latest_before | latest).items()}
    own |= {n: F.max(v).over(with_peers) for n, v in greatest.items()}
    own |= {n: F.sum(v).over(up_to) for n, v in total.items()}
    own = {f"_own_{n}": value for n, value in own.items()}
    is_last = {"_last": F.lead(F.lit(1)).over(ordered).isNull()}
    gaps = {"_before": F.lag(at).over(ordered)} if pause is not None else {}
    local = tagged.select("*", *[value.alias(n) for n, value in (row | own | is_last | gaps).items()])
    if pause is not None:
        opens = F.coalesce(F.col(at) - F.col("_before") > pause, F.lit(False))
        local = local.withColumn("_opens", opens).select(
            "*",
            F.count_if("_opens").over(up_to).alias("_opened"),
            F.last(F.when(F.col("_opens"), F.col(at)), ignorenulls=True).over(up_to).alias("_open_at"),
            F.first(at).over(up_to).alias("_begin"),
        )

    # The condition on the hash always holds. It makes the states need all columns, so that they and
    # the rows come from the same exchange, and the input is read and shuffled once.
    all_columns = F.pmod(F.xxhash64(*df.columns), F.lit(2)) < 2
    states = local.where(F.col("_last") & all_columns)
    along = Window.partitionBy(*keys).orderBy("_bucket", "_slice")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = {n: F.last(f"_own_{n}", ignorenulls=True).over(earlier) for n in latest_before | latest}
    carried |= {n: F.max(f"_own_{n}").over(earlier) for n in greatest}
    carried |= {n: F.sum(f"_own_{n}").over(earlier) for n in total}
    carried = {f"_carry_{n}": value for n, value in carried.items()}
    if pause is None:
        carry = states.select(*slice_, *[value.alias(n) for n, value in carried.items()])
    else:
        gap = F.col("_begin") - F.lag(at).over(along)
        states = states.withColumn("_first_opens", F.coalesce(gap > pause, F.lit(True)))
        all_opened = F.col("_opened") + F.col("_first_opens").cast("bigint")
        newest = F.coalesce("_open_at", F.when(F.col("_first_opens"), F.col("_begin")))
        carry = states.select(
            *slice_,
            "_first_opens",
            F.coalesce(F.sum(all_opened).over(earlier), F.lit(0)).alias("_offset"),
            F.last(newest, ignorenulls=True).over(earlier).alias("_carried_at"),
            *[value.alias(n) for n, value in carried.items()],
        )
    joined = local.join(carry, slice_)

    values = {n: F.coalesce(f"_row_{n}", f"_carry_{n}") for n in latest_before}
    values |= {n: F.coalesce(f"_own_{n}", f"_carry_{n}") for n in latest}
    # A value of this slice may be smaller than one carried into it; nulls are skipped.
    values |= {n: F.greatest(f"_own_{n}", f"_carry_{n}") for n in greatest}
    values |= {n: F.col(f"_own_{n}") + F.coalesce(f"_carry_{n}", F.lit(0)) for n in total}
    if pause is not None:
        first = F.when(F.col("_first_opens"), F.col("_begin")).otherwise(F.col("_carried_at"))
        values["opens_session"] = F.col("_opens") | (F.col("_before").isNull() & F.col("_first_opens"))
        values["session_first_micros"] = F.coalesce(F.col("_open_at"), first)
        values["session_number"] = F.col("_offset") + F.col("_first_opens").cast("bigint") + F.col("_opened")
    return joined.select(*df.columns, *[value.alias(name) for name, value in values.items()])


def sessionise(
    df: DataFrame,
    user: str,
    micros: str,
    *,
    gap_micros: int = 30 * 60 * 1_000_000,
    tie_breakers: Sequence[str] = (),
    latest_before: Mapping[str, Column] | None = None,
    total: Mapping[str, Column] | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Number the visits of each user (G1): a pause longer than the gap opens a new one.

    Adds ``session_number``, ``session_first_micros`` and ``opens_session``. A pause of
    exactly the gap does not end a session. Other running values of the user can be
    taken along in the same pass.
    """
    return running(
        df,
        [user],
        day_bucket(micros),
        [micros, *tie_breakers],
        latest_before=latest_before,
        total=total,
        pause=gap_micros,
        slice_rows=slice_rows,
    )
