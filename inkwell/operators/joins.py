"""Joins to lookup tables of unknown size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPREAD = 4096
# Keys joined apart: those with more rows than one in MOST_KEYS, so there are fewer than MOST_KEYS.
MOST_KEYS = 100_000
LEAST_ROWS = 64


def heavy_keys(facts: DataFrame, key: str) -> DataFrame:
    """The keys that hold more than one row in ``MOST_KEYS``, and more than ``LEAST_ROWS`` rows.

    At most ``MOST_KEYS`` keys can do so, whatever the number of rows, which bounds the table.
    """
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    limit = counts.agg(F.greatest(F.sum("_rows") / MOST_KEYS, F.lit(LEAST_ROWS))).scalar()
    return counts.where(F.col("_rows") > limit).select(key)


def lookup(
    facts: DataFrame, table: DataFrame, key: str, spread_by: Sequence[str], heavy: DataFrame | None = None
) -> DataFrame:
    """Left join on a key that is null for many rows.

    No broadcast is forced: Spark broadcasts the table while its measured size is below
    the session's threshold and shuffles both sides beyond it. For that second case the
    rows without a key, which can match nothing, are spread by a hash of other columns,
    as they would otherwise all meet in one task.

    With ``heavy``, the table's rows of these keys (see :func:`heavy_keys`) are sent to all
    tasks, and the facts that they match are spread like those without a key, so a key that
    holds a third of the facts costs no more than others. The table has a key once.
    """
    names = [c for c in table.columns if c != key]
    spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*spread_by), F.lit(_SPREAD)).cast("string"))
    if heavy is None:
        keyed = facts.withColumn("_lookup", F.coalesce(_text(facts, key), spread))
        named = table.withColumn("_lookup", _text(table, key)).drop(key)
        return keyed.join(named, "_lookup", "left").drop("_lookup")
    hot = table.join(F.broadcast(heavy.select(key)), key, "left_semi")
    hot = hot.select(F.col(key).alias("_heavy"), F.struct(*names, F.lit(1).alias("_found")).alias("_hot"))
    met = facts.join(F.broadcast(hot), F.col(key) == F.col("_heavy"), "left")
    keyed = met.withColumn("_lookup", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), _text(facts, key)).otherwise(spread))
    rest = table.select(_text(table, key).alias("_lookup"), F.struct(*names).alias("_rest"))
    values = [F.coalesce(F.col(f"_hot.{n}"), F.col(f"_rest.{n}")).alias(n) for n in names]
    return keyed.join(rest, "_lookup", "left").select(*[F.col(c) for c in facts.columns], *values)


def _text(rows: DataFrame, key: str) -> Column:
    """The key as text; bytes as hexadecimal digits, as not all bytes are text."""
    return F.hex(key) if dict(rows.dtypes)[key] == "binary" else F.col(key).cast("string")
