"""Joins by position and time: points in ranges, and states as of an event, without a loop over all pairs.

A range is cut into buckets of a width near its own length (a power of eight not over it, so at most nine pieces), and a
point looks once at each width that occurs: it meets a range by the equality of keys, width and bucket, and then by its
bounds.  Long and short ranges thus have few pieces each, and no bucket holds ranges much shorter than itself.

An event meets the last state at or before it in a window over both in order of time.  Keys with very many rows are cut
by time: windows run inside a key's stretches of ``width``, and the last state of each stretch is handed on to the next
ones by a window over stretches.

Null keys, points, times and starts match nothing; ranges that end at or before their start hold no point; a range without
end (null) is open; repeated rows match as often as they occur; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Widths of the buckets, as powers of two.
LEVELS = tuple(range(0, 61, 3))
_FAR = 1 << 60


def _given(columns: list[str]) -> str:
    return " and ".join(f"`{c}` is not null" for c in columns)


def in_ranges(points: DataFrame, ranges: DataFrame, keys: list[str], at: str = "at", start: str = "start", end: str = "end") -> DataFrame:
    """The columns of ``points`` and those of ``ranges`` but the keys, for each range of the same keys with start <= at < end.

    ``at``, ``start`` and ``end`` are whole numbers under 2^60; the two tables share no column but the keys.
    """
    cut = ranges.filter(_given([*keys, start])).withColumn("__end", F.coalesce(F.col(end).cast("long"), F.lit(_FAR))).filter(F.col("__end") > F.col(start))
    length, level = F.col("__end") - F.col(start), F.lit(LEVELS[0])
    for n in LEVELS[1:]:
        level = F.when(length >= 1 << n, F.lit(n)).otherwise(level)
    cut = cut.withColumn("__level", level)
    used = sorted(r[0] for r in cut.select("__level").distinct().collect())  # at most as many as there are widths
    if not used:
        return points.join(cut.drop("__end", "__level"), keys).limit(0)
    bucket = lambda c: F.expr(f"shiftright(cast({c} as bigint), __level)")
    cut = cut.withColumn("__bucket", F.explode(F.sequence(bucket(f"`{start}`"), bucket("__end - 1"))))
    looks = points.filter(_given([*keys, at])).withColumn("__level", F.explode(F.array(*map(F.lit, used)))).withColumn("__bucket", bucket(f"`{at}`"))
    met = looks.join(cut, [*keys, "__level", "__bucket"]).filter((F.col(start) <= F.col(at)) & (F.col(at) < F.col("__end")))
    return met.drop("__level", "__bucket", "__end")


def as_of(events: DataFrame, states: DataFrame, key: str, time: str, since: str, width: int | None = None, until: str | None = None) -> DataFrame:
    """``events`` with state: a struct of the columns of the last of ``states`` with the same key and since <= time; null without.

    ``time`` and ``since`` are whole numbers (of seconds, say).  Of states of one key and moment the greatest counts.  With ``until``,
    a state that has ended by then (null: it never does) is none.
    """
    stretch = lambda c: F.floor(F.col(c) / F.lit(width)) if width else F.lit(0).cast("long")
    own = F.struct(*events.columns)
    kept = F.struct(F.col(since).alias("__since"), *states.columns)
    some = states.filter(_given([key, since]))
    held = some.select(F.col(key).alias("__key"), F.col(since).cast("long").alias("__at"), stretch(since).alias("__stretch"), kept.alias("__state"), F.lit(None).cast(events.select(own.alias("e")).schema["e"].dataType).alias("__event"))
    asks = events.select(F.col(key).alias("__key"), F.col(time).cast("long").alias("__at"), stretch(time).alias("__stretch"), F.lit(None).cast(held.schema["__state"].dataType).alias("__state"), own.alias("__event"))
    both = held.unionByName(asks.filter("__key is not null and __at is not null"))
    # of one moment the states come first, the greatest last
    order = [F.col("__at"), F.col("__event").isNotNull(), F.col("__state")]
    running = Window.partitionBy("__key", "__stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("__near", F.last("__state", True).over(running)).filter("__event is not null")
    lasts = held.groupBy("__key", "__stretch").agg(F.max(F.struct("__at", "__state"))["__state"].alias("__last"))
    # each stretch of a key with its events, after the states of those before
    stretches = lasts.unionByName(asks.filter("__key is not null and __at is not null").select("__key", "__stretch").distinct().withColumn("__last", F.lit(None).cast(held.schema["__state"].dataType)))
    stretches = stretches.groupBy("__key", "__stretch").agg(F.max("__last").alias("__last"))
    before = Window.partitionBy("__key").orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = stretches.withColumn("__carry", F.last("__last", True).over(before)).select("__key", "__stretch", "__carry")
    found = near.join(carried, ["__key", "__stretch"]).withColumn("state", F.coalesce("__near", "__carry"))
    if until:
        over = F.col(f"state.{until}").isNotNull() & (F.col(f"state.{until}") <= F.col("__at"))
        found = found.withColumn("state", F.when(~over, F.col("state")))
    lost = events.filter(f"not ({_given([key, time])})").withColumn("state", F.lit(None).cast(states.select(F.struct(*states.columns).alias("s")).schema["s"].dataType))
    columns = [F.col(f"__event.{c}").alias(c) for c in events.columns]
    state = F.when(F.col("state").isNotNull(), F.struct(*(F.col(f"state.{c}").alias(c) for c in states.columns))).alias("state")
    return found.select(*columns, state).unionByName(lost)
