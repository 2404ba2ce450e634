"""URL parts and query parameters."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell import fixed_values as fixed


def _first_group(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def page_path(url: Column) -> Column:
    return _first_group(url, fixed.PATH_PATTERN)


def page_hostname(url: Column) -> Column:
    return _first_group(url, fixed.HOST_PATTERN)


def page_query_string(url: Column) -> Column:
    return _first_group(url, fixed.QUERY_STRING_PATTERN)


def remove_params(url: Column, names: Sequence[str]) -> Column:
    """``url`` without the named query parameters; ``*all*`` cuts the whole query."""
    if not names:
        return url
    if "*all*" in names:
        return F.regexp_replace(url, r"(?s)[?&#].*", "")
    choice = "|".join(re.escape(name) for name in names)
    return F.regexp_replace(url, rf"[?&#](?:{choice})=[^?&#]*", "")


def param_value(url: Column, name: str) -> Column:
    """Value of one query parameter, matched on its whole name."""
    return _first_group(url, rf"[?&]{re.escape(name)}=([^?&#]*)")


def path_level(url: Column, level: int) -> Column:
    """Path segment ``level`` (1 is the first) with a leading slash, or null."""
    segment = F.split_part(url, F.lit("/"), F.lit(level + 3))
    segment = F.split_part(segment, F.lit("?"), F.lit(1))
    return F.when(segment != "", F.concat(F.lit("/"), segment))


def article_number(url: Column) -> Column:
    """Article number inside a URL, as text."""
    return _first_group(url, fixed.ARTICLE_URL_PATTERN)
