"""Text records to typed rows, with the rejected rows kept.

Each parser returns ``Parsed(kept, rejected)``; every input row is in exactly one of
them.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater import schemas
from tidewater.functions import json as js
from tidewater.functions import text as tx


class Parsed(NamedTuple):
    kept: DataFrame
    rejected: DataFrame


def _divide(df: DataFrame, raw: Column, record: Callable[[Column], Column], good: Callable[[Column, Column], Column],
            keep: tuple[str, ...]) -> Parsed:
    """Split ``df`` by whether ``good(raw, record)`` holds.

    The kept side expands an array of no or one record instead of filtering, so the
    text is parsed once; a filter would be pushed below the parse and repeat it.
    """
    built = F.transform(F.array(raw), lambda r: F.struct(r.alias("raw"), record(r).alias("record")))
    accepted = F.filter(built, lambda b: F.coalesce(good(b["raw"], b["record"]), F.lit(False)))
    kept = df.select(*keep, F.inline(F.transform(accepted, lambda b: b["record"])))
    return Parsed(kept, df.where(F.size(accepted) == 0))


def parse_json_records(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    keep: tuple[str, ...] = (),
    missing_int: int | None = None,
    bad_int: str = "reject",
) -> Parsed:
    """JSON objects to ``schema`` (string and int fields).

    ``missing_int`` is the value of an absent int member. ``bad_int`` says what an
    unreadable int does: ``reject`` the row or read as ``null``.
    """
    if bad_int not in ("reject", "null"):
        raise ValueError("bad_int must be 'reject' or 'null'")
    numbers = [f.name for f in schema.fields if isinstance(f.dataType, T.IntegerType)]
    if any(not isinstance(f.dataType, (T.StringType, T.IntegerType)) for f in schema.fields):
        raise ValueError("only string and int members are supported")

    def record(raw: Column) -> Column:
        return F.struct(*[
            (_int_member(raw[n], missing_int) if n in numbers else raw[n]).alias(n) for n in schema.names
        ])

    def good(raw: Column, _: Column) -> Column:
        ok = raw.isNotNull()
        if bad_int == "reject":
            for n in numbers:
                ok = ok & (raw[n].isNull() | tx.parse_int(raw[n]).isNotNull())
        return ok

    return _divide(df, js.sealed_fields(F.col(value), schema.names), record, good, keep)


def _int_member(member: Column, missing: int | None) -> Column:
    number = tx.parse_int(member)
    return number if missing is None else F.when(member.isNull(), F.lit(missing)).otherwise(number)


def parse_event_json(df: DataFrame, value: str = "value", **options: object) -> Parsed:
    return parse_json_records(df, schemas.EVENT, value, **options)


def parse_dynamic_json(df: DataFrame, value: str = "value", member_column: str = "members") -> Parsed:
    """Schemaless objects: one ``map<string,variant>`` column next to the text."""
    members = F.when(tx.has_text(F.col(value)), js.json_members(F.col(value)))
    found = F.filter(F.array(F.struct(members.alias(member_column))), lambda m: m[member_column].isNotNull())
    others = [c for c in df.columns if c != member_column]
    return Parsed(df.select(*others, F.inline(found)), df.where(F.size(found) == 0))


def parse_csv_pair(df: DataFrame, value: str = "value", names: tuple[str, str] = ("event", "pv"),
                   keep: tuple[str, ...] = ()) -> Parsed:
    """``text,long`` lines; further fields are ignored."""
    def record(fields: Column) -> Column:
        return F.struct(F.get(fields, F.lit(0)).alias(names[0]), tx.parse_long(F.get(fields, F.lit(1))).alias(names[1]))

    fields = tx.split_on(tx.trim_controls(F.col(value)), ",")
    return _divide(df, fields, record, lambda _, pair: pair[names[1]].isNotNull(), keep)


# A metrics line has at least this many fields; these positions are read.
HOST_FIELDS = 11
HOST_POSITIONS = {"os_name": 0, "total_cup": 3, "cup_ratio": 4, "total_memory": 5, "memory_ratio": 6,
                  "eventTime": 9, "reservedTime": 10}


def parse_host_metrics(df: DataFrame, value: str = "value", load_millis: Column | None = None,
                       keep: tuple[str, ...] = ()) -> Parsed:
    """Pipe-delimited metrics lines.

    Fields without a position stay null, the version number stays 0.0. ``load_millis``
    fills ``timeStamp``; by default it is the time the query or micro-batch started.
    """
    stamp = F.unix_millis(F.current_timestamp()) if load_millis is None else load_millis

    def column(split: Column, field: T.StructField) -> Column:
        if field.name == "timeStamp":
            return stamp
        if field.name == "os_version":
            return F.lit(0.0)
        if field.name not in HOST_POSITIONS:
            return F.lit(None)
        text = F.get(split, F.lit(HOST_POSITIONS[field.name]))
        if isinstance(field.dataType, T.IntegerType):
            return tx.parse_int(text)
        return tx.parse_long(text) if isinstance(field.dataType, T.LongType) else text

    def record(split: Column) -> Column:
        return F.struct(*[column(split, f).cast(f.dataType).alias(f.name) for f in schemas.HOST_METRICS.fields])

    def good(split: Column, host: Column) -> Column:
        return (F.size(split) >= HOST_FIELDS) & host["total_cup"].isNotNull() & host["eventTime"].isNotNull()

    return _divide(df, tx.split_on(F.col(value), "|"), record, good, keep)
