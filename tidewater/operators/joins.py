"""Windowed co-groups and joins of two logs, and enrichment by a small table.

Two rows belong together when they carry the same user and the same event time, so
they also fall in the same window; the window only bounds what a stream remembers.

No hint forces a strategy on the log joins: the sides have no size bound. Adaptive
execution splits a shuffle partition that one key has made too large. A stream has no
such help, as its partitions are fixed: there hot keys are salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.display import browse_text, click_text
from tidewater.functions.times import parse_event_time

WINDOW = "window"
LEFT, RIGHT = "left_", "right_"
SALT = "salt_of_join"
NULL_TEXT = "null"


def _side(df: DataFrame, prefix: str, time: str, width: str, keys: Sequence[str], null_keys: str,
          salt: Column | None = None) -> DataFrame:
    """Rows of a side with prefixed columns, and with a ``salt`` as another."""
    if null_keys == "reject":
        for key in keys:
            df = df.where(F.col(key).isNotNull())
    elif null_keys == "as_text":
        df = df.select(*[F.coalesce(c, F.lit(NULL_TEXT)).alias(c) if c in keys else F.col(c) for c in df.columns])
    else:
        raise ValueError("null_keys must be 'reject' or 'as_text'")
    windowed = df.withColumn(WINDOW, F.window(F.col(time), width))
    return windowed.select(F.col(WINDOW).alias(prefix + WINDOW), *([] if salt is None else [salt.alias(prefix + SALT)]),
                           *[F.col(c).alias(prefix + c) for c in df.columns if c != time])


def _is_hot(keys: Sequence[str], hot: Column | Sequence[tuple] | None) -> Column:
    if hot is None:
        return F.lit(True)
    if isinstance(hot, Column):
        return F.coalesce(hot, F.lit(False))
    if any(len(values) != len(keys) for values in hot):
        raise ValueError(f"a hot key has a value for each of {list(keys)}")
    found = F.lit(False)
    for values in hot:
        same = F.lit(True)
        for key, value in zip(keys, values, strict=True):
            same = same & F.col(key).eqNullSafe(F.lit(value))
        found = found | same
    return found


def _salt(df: DataFrame, dealt: bool, salts: int, keys: Sequence[str], hot: Column | Sequence[tuple] | None) -> Column:
    """A row that is ``dealt`` has one salt, by its hash; any other a copy for each."""
    if dealt:
        own = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")
        return F.when(_is_hot(keys, hot), own).otherwise(F.lit(0))
    each = F.sequence(F.lit(0), F.lit(salts - 1))
    return F.explode(F.when(_is_hot(keys, hot), each).otherwise(F.array(F.lit(0))))


def hot_keys(rows: DataFrame, keys: Sequence[str], share: float = 0.01) -> list[tuple]:
    """The keys that more than ``share`` of all ``rows`` have; at most ``1 / share``, whatever the size of the table."""
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return [tuple(r)[:-1] for r in counts.join(rows.agg(F.count(F.lit(1)).alias("all")), F.col("n") > F.col("all") * share)
            .select(*keys, "n").collect()]


def window_join(left: DataFrame, right: DataFrame, how: str, time: str, width: str, keys: Sequence[str],
                null_keys: str = "reject", salts: int = 1, salted: str | None = None,
                hot: Column | Sequence[tuple] | None = None) -> DataFrame:
    """``inner``, ``left`` or ``right`` join per window and keys.

    Columns come back prefixed ``left_`` and ``right_``, without ``time``. On streams both inputs need a
    watermark on ``time``; unmatched rows appear once their window has closed. Rows with
    a null key match nothing and are left out, or match each other with ``as_text``.

    With ``salts`` above 1, the rows of a key on the ``salted`` side (``left`` or ``right``) are dealt to so many parts and
    the key's rows on the other side copied to each, so the state and work of a hot key spread over tasks. The result
    is the same. In an outer join the side that is kept whole is the salted one: its rows are there once, so
    one without a match comes out once. ``hot`` names the keys to salt, as ``hot_keys`` finds them, or is a condition
    on the keys; without it all are, and the other side is copied whole.
    """
    if how not in ("inner", "left", "right"):
        raise ValueError(f"unknown join {how!r}")
    salt, added = {"left": None, "right": None}, [WINDOW]
    if salts > 1:
        whole = how if how != "inner" else salted or "left"
        if salted not in (None, whole):
            raise ValueError(f"a {how} join salts its {how} side")
        salt = {s: _salt(df, s == whole, salts, keys, hot) for s, df in (("left", left), ("right", right))}
        added = [WINDOW, SALT]
    ours = _side(left, LEFT, time, width, keys, null_keys, salt["left"])
    theirs = _side(right, RIGHT, time, width, keys, null_keys, salt["right"])
    same = F.lit(True)
    for column in [*added, *keys]:
        same = same & (F.col(LEFT + column) == F.col(RIGHT + column))
    return ours.join(theirs, same, how).drop(*[side + c for side in (LEFT, RIGHT) for c in added])


def render_join(joined: DataFrame, how: str) -> DataFrame:
    """The text of a joined pair; a missing side reads ``null``."""
    label = {"inner": " ==Inner Join=> ", "left": " ==Left Join=> ", "right": " ==Right Join=> "}[how]
    left = F.when(F.col(LEFT + "userID").isNotNull(), browse_text(LEFT)).otherwise(F.lit(NULL_TEXT))
    right = F.when(F.col(RIGHT + "userID").isNotNull(), click_text(RIGHT)).otherwise(F.lit(NULL_TEXT))
    return joined.select(F.concat(left, F.lit(label), right).alias("line"))


def log_times(df: DataFrame, text: str = "eventTime", time: str = "ts") -> DataFrame:
    """Add the timestamp of the event-time text; rows without one are dropped."""
    return df.withColumn(time, parse_event_time(F.col(text))).where(F.col(time).isNotNull())


def cogroup_rows(left: DataFrame, right: DataFrame, time: str, width: str, keys: Sequence[str],
                 payload_left: Column, payload_right: Column) -> DataFrame:
    """Every row of both sides, labelled with its window, keys and side.

    The members of a group stay separate rows, so nothing is shuffled and a group may
    be of any size. ``payload_*`` says what is kept of a row.
    """
    def labelled(df: DataFrame, side: str, payload: Column) -> DataFrame:
        return df.select(F.window(F.col(time), width).alias(WINDOW), *keys, F.lit(side).alias("side"),
                         payload.alias("payload"))

    return labelled(left, "left", payload_left).unionByName(labelled(right, "right", payload_right))


def cogroup_summary(members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per side and the payload range of each group, summed before the shuffle."""
    left, right = F.col("side") == "left", F.col("side") == "right"
    return members.groupBy(WINDOW, *keys).agg(
        F.count_if(left).alias("n_left"),
        F.count_if(right).alias("n_right"),
        F.min(F.when(left, F.col("payload"))).alias("first_left"),
        F.max(F.when(left, F.col("payload"))).alias("last_left"),
        F.min(F.when(right, F.col("payload"))).alias("first_right"),
        F.max(F.when(right, F.col("payload"))).alias("last_right"),
    )


def enrich(events: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Add the dimension's columns; events without an entry are dropped.

    Spark compares the dimension's measured size with ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return events.join(dimension, key, "inner")
