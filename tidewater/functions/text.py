"""Splitting, trimming and joining text.

The split rule is the JVM string one: separators at the end make no empty
elements, separators elsewhere do, and the empty text is one empty element.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_on(value: Column, separator: str) -> Column:
    """Split on one literal character."""
    if len(separator) != 1:
        raise ValueError("separator must be one character; use split_pattern for a regex")
    body = F.rtrim(value, F.lit(separator))
    return _split(value, body, re.escape(separator))


def split_pattern(value: Column, pattern: str) -> Column:
    """Split on a regular expression."""
    body = F.regexp_replace(value, F.lit(f"(?:{pattern})+\\z"), F.lit(""))
    return _split(value, body, pattern)


def _split(value: Column, body: Column, pattern: str) -> Column:
    def pieces(text: Column) -> Column:
        only_separators = (text == "") & (F.length(value) > 0)
        return F.when(only_separators, F.array().cast("array<string>")).otherwise(F.split(text, pattern))

    return once(body, pieces)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated one time, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def trim_controls(value: Column) -> Column:
    """Strip every character up to U+0020 from both ends."""
    return F.regexp_replace(value, "\\A[\\x00-\\x20]+|[\\x00-\\x20]+\\z", "")


def parse_long(value: Column) -> Column:
    """Signed decimal digits and nothing else, else null."""
    return F.when(value.rlike("\\A[+-]?[0-9]+\\z"), value.try_cast("bigint"))


def parse_int(value: Column) -> Column:
    return F.when(value.rlike("\\A[+-]?[0-9]+\\z"), value.try_cast("int"))


def has_text(value: Column) -> Column:
    return value.isNotNull() & (F.length(value) > 0)


def join_fields(separator: str, *fields: Column) -> Column:
    """Join with nulls spelled out, so the number of fields never changes."""
    return F.concat_ws(separator, *[F.coalesce(f.cast("string"), F.lit("null")) for f in fields])


def rejoin_first_two(value: Column, separator: str = ":", glue: str = ">>") -> Column:
    """``a:b:c`` becomes ``a>>b``; null when there is no second field."""
    fields = split_on(value, separator)
    return F.when(F.size(fields) > 1, F.concat(F.get(fields, F.lit(0)), F.lit(glue), F.get(fields, F.lit(1))))


def whole_mean(total: Column, count: Column) -> Column:
    """Mean of integers, cut toward zero."""
    return F.call_function("div", total, count)
