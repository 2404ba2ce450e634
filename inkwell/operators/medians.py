"""Exact medians of columns with any number of distinct values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 1024


@dataclass
class _Search:
    """The value of one rank (from 0) of a column, known to lie between two values that occur."""

    column: str
    low: object
    high: object
    rank: int

    def bin(self) -> Column:
        """The part of the range that a row's value lies in; null for other rows. It rises with the value."""
        x = F.col(self.column)
        # Differences of whole numbers are exact, and those of fractions are halved, so neither overflows.
        kind, half = ("double", 0.5) if isinstance(self.low, float) else ("decimal(38,0)", 1)
        low, high, here = (c.cast(kind) * F.lit(half) for c in (F.lit(self.low), F.lit(self.high), x))
        share = (here - low).cast("double") / (high - low).cast("double")
        part = F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")
        return F.when(x.between(F.lit(self.low), F.lit(self.high)), part)

    def narrow(self, bins: list) -> None:
        for b in sorted(bins, key=lambda r: r.bin):
            if self.rank < b.rows:
                self.low, self.high = b.low, b.high
                return
            self.rank -= b.rows


def exact_medians(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the median of each numeric column, as a double; null for a column of nulls.

    The middle ranks are searched for: in each round the range that holds a rank is cut into
    ``BINS`` parts, the rows of each are counted with their least and greatest value, and the part with
    the rank is the next range. A round is one aggregation with ``BINS`` groups for each rank, and the
    ends of a range fall into different parts, so the rounds end with a single value. Between two
    middle values the median is halfway.
    """
    numbers = rows.select(*columns)
    ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("n", F.count), ("low", F.min), ("high", F.max))]
    found = numbers.agg(*ends).first()
    searches: dict[str, list[_Search]] = {}
    for c in columns:
        n = found[f"n_{c}"]
        ranks = sorted({(n - 1) // 2, n // 2}) if n else []
        searches[c] = [_Search(c, found[f"low_{c}"], found[f"high_{c}"], rank) for rank in ranks]
    while open_ := [s for all_ in searches.values() for s in all_ if s.low != s.high]:
        # Columns of one type are searched in one pass.
        for kind in {numbers.schema[s.column].dataType for s in open_}:
            same = [s for s in open_ if numbers.schema[s.column].dataType == kind]
            marks = [
                F.struct(F.lit(i).alias("search"), s.bin().alias("bin"), F.col(s.column).alias("x"))
                for i, s in enumerate(same)
            ]
            counted = _bins(numbers.select(F.inline(F.array(*marks))))
            for i, s in enumerate(same):
                s.narrow([b for b in counted if b.search == i])
    values = [sum(float(s.low) for s in all_) / len(all_) if all_ else None for all_ in searches.values()]
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in columns])
    return rows.sparkSession.createDataFrame([tuple(values)], schema)


def _bins(marked: DataFrame) -> list:
    return (
        marked.where(F.col("bin").isNotNull())
        .groupBy("search", "bin")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("x").alias("low"), F.max("x").alias("high"))
        .collect()
    )
