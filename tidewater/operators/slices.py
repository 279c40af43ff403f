"""Row-order work that does not need a whole key in one task.

A plain ``Window.partitionBy(key).orderBy(...)`` sorts all rows of a key in one
task, so a key with a third of the rows stops the job. Here each key's rows are cut
into consecutive slices, the window runs per ``(key, slice)``, and what a slice needs
from the slices before it comes from a small table of per-slice aggregates.

The cuts are rows of the table itself: of the rows whose key and order hash to zero
modulo ``CANDIDATE``, as many as make about ``slices`` slices, again by a hash. They
depend on the data only, so a task that is run again places its rows in the same slices,
and there are about ``slices`` of them however many rows or keys there are. That bounds
the tables that are broadcast.

The input is read twice: for the candidates, of which only key and order columns are
needed, and for the one exchange that deals the rows out by key and slice. Window and
slice aggregates both work on what that exchange has written. Give only columns that the
result keeps: if later columns go unused, the plan may read the input once more.

The order columns together must be unique per key, as in any running calculation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "_slice"

SLICES_PER_SHUFFLE_PARTITION = 4
#: One row in so many may be a cut; fewer rows than that need no slices.
CANDIDATE = 1024


def default_slices(df: DataFrame) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return SLICES_PER_SHUFFLE_PARTITION * partitions


def _kept(df: DataFrame) -> Column:
    """Something of every column, so that an aggregate reads the same exchange as the rows themselves."""
    hashable = (T.AtomicType, T.NullType)
    plain = [F.col(f.name) if isinstance(f.dataType, hashable) and not isinstance(f.dataType, T.VariantType)
             else F.col(f.name).isNull() for f in df.schema.fields]
    return F.first(F.xxhash64(*plain))


@dataclass(frozen=True)
class Sliced:
    """Rows dealt out by key and slice; ``window`` covers one slice of one key in order.

    ``cut_keys`` are the keys of more than one slice.
    """

    rows: DataFrame
    cut_keys: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]

    @property
    def window(self):
        return Window.partitionBy(*self.keys, SLICE).orderBy(*self.order)

    @property
    def upto_here(self):
        return self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def with_columns(self, columns: dict[str, Column]) -> Sliced:
        """Add columns that later aggregates over slices may use."""
        rows = self.rows
        for name, column in columns.items():
            rows = rows.withColumn(name, column)
        return Sliced(rows, self.cut_keys, self.keys, self.order)

    def carry(self, **merges: tuple[Column, str]) -> Sliced:
        """Add columns holding an aggregate over all earlier slices of the key.

        Each merge is ``(per-slice aggregate, combine)`` with combine ``sum`` or ``max``.
        A first slice gets null. Only keys that were cut take part, so the table has at
        most one row per cut. Rows of a slice are in one task, so nothing is shuffled for it.
        """
        parts = [agg.alias(name) for name, (agg, _) in merges.items()]
        per_slice = self.rows.groupBy(*self.keys, SLICE).agg(*parts, _kept(self.rows).alias("_kept"))
        if self.keys:
            same = [per_slice[k].eqNullSafe(F.col(f"_key_{k}")) for k in self.keys]
            named = self.cut_keys.withColumnsRenamed({k: f"_key_{k}" for k in self.keys})
            per_slice = per_slice.join(F.broadcast(named), same)  # not a semi join: that would be moved below the exchange
        earlier = Window.partitionBy(*self.keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        combine = {"sum": F.sum, "max": F.max}
        before = per_slice.select(
            *self.keys, SLICE, "_kept", *[combine[how](name).over(earlier).alias(name) for name, (_, how) in merges.items()]
        ).where((F.col(SLICE) > 0) & F.col("_kept").isNotNull()).drop("_kept")
        rows = _attach(self.rows, before, [*self.keys, SLICE])
        return Sliced(rows, self.cut_keys, self.keys, self.order)

    def result(self, *drop: str) -> DataFrame:
        return self.rows.drop(SLICE, *drop)


def _cuts_upto(cuts: Column, position: Column) -> Column:
    """How many of the sorted ``cuts`` are at or before ``position``, 0 without cuts.

    Strides of falling powers of two, from the list's length on; a stride past the end compares with null and is not
    taken.
    """
    bits = F.floor(F.log2(F.size(cuts))).cast("int")
    strides = F.transform(F.sequence(bits, F.lit(0), F.lit(-1)), lambda bit: F.call_function("shiftleft", F.lit(1), bit))

    def stride(passed: Column, length: Column) -> Column:
        return F.when(F.get(cuts, passed + length - 1) <= position, passed + length).otherwise(passed)

    return F.when(F.size(cuts) > 0, F.aggregate(strides, F.lit(0), stride)).otherwise(F.lit(0))


def _attach(df: DataFrame, bounded: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a table of at most about one row per cut; null keys match null keys."""
    names = {k: f"_key_{k}" for k in keys}
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    return df.join(F.broadcast(bounded.withColumnsRenamed(names)), same, "left").drop(*names.values())


def _with_key_columns(df: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Add the columns of a small table with one row per key, or of its only row without keys."""
    if keys:
        return _attach(df, per_key, keys)
    row = per_key.select(F.struct(*per_key.columns)).scalar()
    return df.withColumn("_row", row).select(*df.columns, "_row.*")


def _place(df: DataFrame, cuts: DataFrame, keys: list[str], position: Column) -> DataFrame:
    """Search the first cuts of the key's pages, then the page: lists as long as the root of all cuts."""
    sized = cuts.withColumn("_width", F.ceil(F.sqrt(F.size("_cuts"))).cast("int"))
    numbers = F.sequence(F.lit(0), F.expr("(size(_cuts) - 1) div _width").cast("int"))
    heads = sized.select(*keys, "_width", F.transform(
        numbers, lambda page: F.get("_cuts", page * F.col("_width"))).alias("_heads"))
    pages = sized.select(*keys, F.posexplode(F.transform(
        numbers, lambda page: F.slice("_cuts", page * F.col("_width") + 1, F.col("_width")))).alias("_page", "_cuts"))

    found = _with_key_columns(df, heads, keys).select(
        *df.columns, "_width", (_cuts_upto(F.col("_heads"), position) - 1).alias("_page"))
    found = _attach(found, pages, [*keys, "_page"])
    number = F.col("_page") * F.col("_width") + _cuts_upto(F.col("_cuts"), position)
    return found.select(*df.columns, F.when(F.col("_page") >= 0, number).otherwise(F.lit(0)).alias(SLICE))


def slice_rows(df: DataFrame, keys: list[str], order: list[str], slices: int | None = None,
               same_rows: DataFrame | None = None) -> Sliced:
    """Cut the rows of every key (or of the whole table when ``keys`` is empty).

    The rows are read for the cuts and for the result. When ``df`` is costly, ``same_rows`` may name a frame with the same
    rows to read for the first. With ``slices`` given, every row may be a cut, also of small tables.
    """
    wanted, rate = slices or default_slices(df), CANDIDATE if slices is None else 1
    place, position = list(dict.fromkeys([*keys, *order])), F.struct(*order)
    basis = (df if same_rows is None else same_rows).select(*place)
    # Counted and chosen from one exchange: conditions on the count of equal rows are not moved below it.
    candidates = basis.where(F.pmod(F.xxhash64(*place), F.lit(rate)) == 0).groupBy(*place).agg(
        F.count(F.lit(1)).alias("_equal"))
    there = F.col("_equal") > 0
    every = F.ceil(candidates.agg(F.greatest(F.count_if(there), F.lit(1))).scalar() / F.lit(wanted)).cast("bigint")
    chosen = candidates.where(F.when(there, F.pmod(F.xxhash64(F.lit("cut"), *place), every)) == 0)
    cuts = chosen.groupBy(*keys).agg(F.sort_array(F.collect_set(position)).alias("_cuts")).where(F.size("_cuts") > 0)
    placed = _place(df, cuts, keys, position).repartition(*keys, SLICE)
    return Sliced(placed, cuts.select(*keys), tuple(keys), tuple(order))
