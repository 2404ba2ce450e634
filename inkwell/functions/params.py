"""Typed values out of key/value arrays."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIELD_OF_KIND = {
    "string": "string_value",
    "lower_string": "string_value",
    "int": "int_value",
    "float": "float_value",
    "double": "double_value",
}
_CAST_OF_KIND = {"int": "bigint", "float": "double", "double": "double"}


def param(pairs: Column, key: str, kind: str = "string") -> Column:
    """The value stored under ``key``, or null. The first of repeated keys wins.

    Looks the position up in the key array and reads the same position of the value
    array. Unlike a lambda filter this compiles into the stage's generated code, and
    lets Parquet skip the value fields nobody asked for.
    """
    field = _FIELD_OF_KIND.get(kind, kind)
    position = F.array_position(pairs["key"], key).cast("int") - 1
    value = F.get(pairs["value"][field], position)
    if kind == "lower_string":
        return F.lower(value)
    if kind in _CAST_OF_KIND:
        return value.cast(_CAST_OF_KIND[kind])
    return value


def session_id(pairs: Column) -> Column:
    """Session id: the integer, else the digits of ``s<digits>$...``, else 0."""
    text = param(pairs, "ga_session_id")
    head = F.split_part(text, F.lit("$"), F.lit(1))
    digits = F.nullif(F.split_part(head, F.lit("s"), F.lit(2)), F.lit(""))
    return F.coalesce(
        param(pairs, "ga_session_id", "int"), digits.try_cast("bigint"), F.lit(0).cast("bigint")
    )


def session_engaged(pairs: Column) -> Column:
    """Engagement flag, sent either as an integer or as the text '1'."""
    return F.coalesce(
        param(pairs, "session_engaged", "int"),
        F.when(param(pairs, "session_engaged") == "1", F.lit(1).cast("bigint")),
    )


def column_name(text: str) -> str:
    """A valid column name for an event name."""
    name = re.sub(r"[^a-zA-Z0-9_]", "_", text)
    return f"_{name}" if name[:1].isdigit() else name
