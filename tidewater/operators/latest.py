"""The newest value per key, for lookups from outside and for keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key. An aggregate, so each task sends one row per key at most."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def look_up(table: DataFrame, key: str, wanted: Sequence[object]) -> DataFrame:
    """Rows of the named keys; the filter reaches the scan."""
    return table.where(F.col(key).isin(list(wanted)))
