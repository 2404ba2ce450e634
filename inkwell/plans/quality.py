"""Data-quality checks (T1 to T7). Each returns one row: check, level, failures, passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _result(counted: DataFrame, check: str, level: str) -> DataFrame:
    """A check with level ``warn`` reports its failures but passes (T5)."""
    passed = F.lit(True) if level == "warn" else F.col("failures") == 0
    return counted.select(
        F.lit(check).alias("check"), F.lit(level).alias("level"), "failures", passed.alias("passed")
    )


def not_null(df: DataFrame, column: str, *, level: str = "error") -> DataFrame:
    """Rows where the column is null."""
    failures = F.count_if(F.col(column).isNull()).alias("failures")
    return _result(df.agg(failures), f"not_null {column}", level)


def unique(
    df: DataFrame, key: Column, name: str, *, where: Column | None = None, level: str = "error"
) -> DataFrame:
    """Values of the key that occur more than once (T2). Null keys are left out."""
    rows = df if where is None else df.filter(where)
    repeated = rows.select(key.alias("key")).filter("key is not null").groupBy("key").count()
    failures = F.count_if(F.col("count") > 1).alias("failures")
    return _result(repeated.agg(failures), f"unique {name}", level)


def unique_combination(df: DataFrame, columns: Sequence[str], *, level: str = "error") -> DataFrame:
    """Combinations that occur more than once."""
    failures = F.count_if(F.col("count") > 1).alias("failures")
    return _result(df.groupBy(*columns).count().agg(failures), f"unique {', '.join(columns)}", level)


def accepted_values(df: DataFrame, column: str, values: Sequence[str], *, level: str = "error") -> DataFrame:
    """Rows with another value (T4). Nulls pass."""
    other = F.col(column).isNotNull() & ~F.col(column).isin(*values)
    return _result(df.agg(F.count_if(other).alias("failures")), f"accepted_values {column}", level)


def control_totals(totals: DataFrame, expected: Mapping[str, float | Column]) -> DataFrame:
    """Compare the one row of a metric query with exact expected values.

    Expected values are numbers, or scalars of another way to compute the same total.
    """
    checks = F.array(
        *[
            F.struct(
                F.lit(name).alias("check"),
                F.col(name).cast("double").alias("actual"),
                (value if isinstance(value, Column) else F.lit(value)).cast("double").alias("expected"),
            )
            for name, value in expected.items()
        ]
    )
    rows = totals.select(F.explode(checks).alias("c")).select("c.*")
    return rows.withColumn("passed", F.col("actual").eqNullSafe(F.col("expected")))


def reconciliation(check: str, left: DataFrame, right: DataFrame, gap: DataFrame | None = None) -> DataFrame:
    """Whether two routes give the same total (T7), up to a gap that is itself counted.

    Each argument is one row with one column.
    """
    known = F.lit(0) if gap is None else F.coalesce(gap.scalar(), F.lit(0))
    values = left.select(
        F.lit(check).alias("check"),
        F.coalesce(F.col(left.columns[0]), F.lit(0)).alias("total"),
        F.coalesce(right.scalar(), F.lit(0)).alias("other_total"),
        known.alias("known_gap"),
    )
    return values.withColumn("passed", F.col("total") == F.col("other_total") + F.col("known_gap"))
