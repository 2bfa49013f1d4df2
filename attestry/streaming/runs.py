"""Runs as streams: late and repeated events, and a timer that closes a run when nothing has come for a while.

``first_events`` drops repeated events for as long as the watermark may still let them in.  ``stale_runs`` keeps one open run
for each key, as two times and a count; when the watermark passes its last event by ``gap`` seconds, a timer closes it and
emits it.  ``run_spans`` is the same over a finished table: what the stream has emitted by its end is what the table gives,
less the runs that are still open.

Events later than the watermark's delay are dropped by the engine.  Null keys and times are in no run.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window


def first_events(events: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """``events`` (a stream) without those whose key has come before within the watermark."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def stale_runs(events: DataFrame, key: str, time: str, gap: int) -> DataFrame:
    """key, started, ended and events of each run of a stream with a watermark, once ``gap`` seconds have passed without an event."""
    step = gap * 1_000_000

    def closed(own: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # open runs in order: [first, last, events], in microseconds; several only while events of a batch lie apart
        runs = [list(r) for r in zip(*state.get)] if state.exists else []
        if not state.hasTimedOut:
            times = sorted(t.value // 1000 for b in batches for t in b[time])
            for t in times:
                runs.append([t, t, 1])
            runs.sort()
            joined: list[list[int]] = []
            for r in runs:
                if joined and r[0] - joined[-1][1] <= step:
                    joined[-1] = [joined[-1][0], max(joined[-1][1], r[1]), joined[-1][2] + r[2]]
                else:
                    joined.append(r)
            runs = joined
        mark = state.getCurrentWatermarkMs() * 1000
        done = [r for r in runs if r[1] + step < mark]
        left = [r for r in runs if r[1] + step >= mark]
        if left:
            state.update(tuple(map(list, zip(*left))))
            state.setTimeoutTimestamp((left[0][1] + step) // 1000 + 1)
        else:
            state.remove()
        yield pd.DataFrame({key: [own[0]] * len(done), "started": [r[0] for r in done], "ended": [r[1] for r in done], "events": [r[2] for r in done]})

    kind = events.schema[key].dataType.simpleString()
    known = events.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(key, time)
    return known.groupBy(key).applyInPandasWithState(closed, f"{key} {kind}, started long, ended long, events long", "firsts array<long>, lasts array<long>, counts array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def run_spans(events: DataFrame, key: str, time: str, gap: int) -> DataFrame:
    """key, started, ended and events (microseconds) of all runs of a finished table: events of a key at most ``gap`` seconds apart."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    own = Window.partitionBy(key).orderBy("at")
    rows = events.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(key, at.alias("at"))
    cut = rows.withColumn("new", F.coalesce((F.col("at") - F.lag("at").over(own) > gap * 1_000_000).cast("int"), F.lit(1)))
    runs = cut.withColumn("run", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(key, "run").agg(F.min("at").alias("started"), F.max("at").alias("ended"), F.count("*").alias("events")).drop("run")
