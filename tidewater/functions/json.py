"""JSON text to columns and back.

Spark's JSON functions accept text after the first value. So each text is parsed as the first of two elements of an array
whose second carries a hash of the text: a text that closes the array itself, or adds elements or members, can't hold its
own hash, so it loses the second element or puts it in another place and counts as bad.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.text import once

SEAL = "tidewater.seal"


def _sealed(value: Column) -> tuple[Column, Column]:
    """The array of the text and its seal, and the seal."""
    seal = F.xxhash64(value).cast("string")
    return F.concat(F.lit("["), value, F.lit(f',{{"{SEAL}":"'), seal, F.lit('"}]')), seal


def sealed_fields(value: Column, names: list[str]) -> Column:
    """Struct of the named members as text, and of the seal; null when the text is not one JSON object.

    Take the members from it by name, inside ``once``: a copy of the struct without the seal would be unfolded to a parse
    for each member.
    """
    inner = T.StructType([T.StructField(n, T.StringType()) for n in [*names, SEAL]])
    text, seal = _sealed(value)
    return once(F.from_json(text, T.ArrayType(inner)), lambda parts: F.when(
        (F.size(parts) == 2) & (F.get(parts, F.lit(1))[SEAL] == seal), F.get(parts, F.lit(0))))


def json_fields(value: Column, names: list[str]) -> Column:
    """Struct of the named members as text; null when the text is not one JSON object."""
    return once(sealed_fields(value, names), lambda found: F.when(
        found.isNotNull(), F.struct(*[found[n].alias(n) for n in names])))


def json_members(value: Column) -> Column:
    """All members of an object as ``map<string,variant>``; null for anything else."""
    text, seal = _sealed(value)
    typed = F.try_parse_json(text).try_cast("array<map<string,variant>>")
    return once(typed, lambda parts: F.when(
        (F.size(parts) == 2) & (F.try_element_at(F.get(parts, F.lit(1)), F.lit(SEAL)).cast("string") == seal),
        F.get(parts, F.lit(0))))


def members_put(members: Column, name: str, replacement: Column) -> Column:
    """The object of parsed ``members`` with one set, as text; other members keep their types."""
    kept = F.map_filter(members, lambda key, _: key != name)
    return F.to_json(F.map_concat(kept, F.create_map(F.lit(name), replacement.cast("variant"))))


def json_put(value: Column, name: str, replacement: Column) -> Column:
    """Set one member of an object's text and write it back."""
    return members_put(json_members(value), name, replacement)


def to_record(*columns: Column | str) -> Column:
    """One JSON object with every member present, nulls included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
