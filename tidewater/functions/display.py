"""Human-readable text for sizes, shares and records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units, their step and the number patterns.
SIZE_UNITS = ("KB", "MB", "GB", "TB")
SIZE_STEP = 1024.0
TWO_DECIMALS = "#.##"
PERCENT = "#.##%"


def format_bytes(size: Column) -> Column:
    """``1536`` becomes ``1.5KB``; the largest unit is TB."""
    text = F.lit(None).cast("string")
    for power, unit in reversed(list(enumerate(SIZE_UNITS, start=1))):
        scaled = size.cast("double") / F.lit(SIZE_STEP**power)
        shown = F.concat(F.call_function("format_number", scaled, F.lit(TWO_DECIMALS)), F.lit(unit))
        text = shown if unit == SIZE_UNITS[-1] else F.when(scaled < SIZE_STEP, shown).otherwise(text)
    return text


def format_share(share: Column) -> Column:
    return F.call_function("format_number", share.cast("double"), F.lit(PERCENT))


def used_share(total: Column, available: Column) -> Column:
    """``(total - available) / total`` as a percentage text."""
    return format_share((total - available).cast("double") / total)


def describe(label: str, *fields: tuple[str, Column, bool]) -> Column:
    """``Label{a='x', b=1}`` from (name, column, quoted) triples; nulls read ``null``."""
    parts: list[Column] = []
    for i, (name, column, quoted) in enumerate(fields):
        quote = "'" if quoted else ""
        lead = "" if i == 0 else ", "
        text = F.coalesce(column.cast("string"), F.lit("null"))
        parts += [F.lit(f"{lead}{name}={quote}"), text, F.lit(quote)]
    return F.concat(F.lit(label + "{"), *parts, F.lit("}"))


# Labels, field order and quoting of the three record texts.
BROWSE_TEXT = ("UserBrowseLog", ("userID", "eventTime", "eventType", "productID"), ("productPrice",))
CLICK_TEXT = ("UserClickLog", ("userID", "eventTime", "eventType", "pageID"), ())
HOST_TEXT_FIELDS = (
    ("timeStamp", False),
    ("os_name", True),
    ("os_arch", True),
    ("os_version", False),
    ("total_cup", False),
    ("cup_ratio", True),
    ("total_memory", True),
    ("memory_ratio", True),
    ("java_version", True),
    ("java_vm_vendo", True),
    ("eventTime", False),
    ("reservedTime", True),
)


def _record_text(layout: tuple, prefix: str) -> Column:
    label, quoted, plain = layout
    fields = [(n, F.col(prefix + n), True) for n in quoted] + [(n, F.col(prefix + n), False) for n in plain]
    return describe(label, *fields)


def browse_text(prefix: str = "") -> Column:
    return _record_text(BROWSE_TEXT, prefix)


def click_text(prefix: str = "") -> Column:
    return _record_text(CLICK_TEXT, prefix)


def host_text() -> Column:
    return describe("Computer", *[(n, F.col(n), quoted) for n, quoted in HOST_TEXT_FIELDS])
