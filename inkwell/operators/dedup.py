"""One row per identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_copy(df: DataFrame, identity: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each identity; nulls in the identity are equal.

    The rank is compared with a constant, so Spark limits each group to one row before
    the shuffle as well as after it. A group of copies of any size sends at most one
    row per input task.
    """
    rank = F.row_number().over(Window.partitionBy(*identity).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
