"""First and last rows of a group as plain aggregates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def earliest(value: Column, order: Column, where: Column | None = None) -> Column:
    """``value`` of the first row; rows where ``where`` does not hold are ignored."""
    return F.min_by(value, order if where is None else F.when(where, order))


def newest(value: Column, order: Column, where: Column | None = None) -> Column:
    return F.max_by(value, order if where is None else F.when(where, order))


def unpack(struct: str, columns: Mapping[str, str]) -> list[Column]:
    """Fields of a struct column under new names (field -> name)."""
    return [F.col(f"{struct}.{field}").alias(name) for field, name in columns.items()]
