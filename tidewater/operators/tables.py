"""Row filters, word splitting and the table/SQL surface."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import text as tx


def non_empty(df: DataFrame, column: str = "value") -> DataFrame:
    return df.where(tx.has_text(F.col(column)))


def equal_to(df: DataFrame, column: str, wanted: str) -> DataFrame:
    return df.where(F.col(column) == wanted)


def words(df: DataFrame, pieces: Column, name: str = "word", keep_empty: bool = False) -> DataFrame:
    """One row per element of ``pieces``."""
    exploded = df.select(F.explode(pieces).alias(name))
    return exploded if keep_empty else exploded.where(F.length(name) > 0)


def count_words(df: DataFrame, pieces: Column, keep_empty: bool = False) -> DataFrame:
    """``word, frequency``; partial sums before the shuffle keep a hot word cheap."""
    return words(df, pieces, "word", keep_empty).groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))


def named(df: DataFrame, names: str | Sequence[str] | None = None) -> DataFrame:
    """Name the columns: ``"word,frequency"``, a list, or ``f0, f1, ...`` by default."""
    if names is None:
        names = [f"f{i}" for i in range(len(df.columns))]
    elif isinstance(names, str):
        names = [n.strip() for n in names.split(",")]
    return df.toDF(*names)


def register(df: DataFrame, view: str, names: str | Sequence[str] | None = None) -> DataFrame:
    """Register a batch or streaming frame under ``view`` for ``spark.sql``."""
    table = df if names is None else named(df, names)
    table.createOrReplaceTempView(view)
    return table


def view_names(spark: SparkSession) -> list[str]:
    return [t.name for t in spark.catalog.listTables()]


def as_records(df: DataFrame, schema) -> DataFrame:
    """Columns matched by name and cast to the declared record types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
