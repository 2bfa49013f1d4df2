"""A write that measures itself: metrics are taken while the table is written, and a gate decides whether it stays.

The input is read once.  Metrics are aggregates that the engine computes on the rows as they pass to the writer
(``DataFrame.observe``); rules are conditions on them.  The table is written beside its place and moved there if all rules
hold; otherwise it goes, and ``Refused`` says which rules failed and what was measured.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation


class Refused(RuntimeError):
    """The written rows break a rule: ``failed`` names the rules, ``metrics`` has what was measured."""

    def __init__(self, failed: list[str], metrics: Mapping[str, object]):
        super().__init__(f"refused by {', '.join(failed)}: {dict(metrics)}")
        self.failed, self.metrics = failed, dict(metrics)


def gated_write(df: DataFrame, path: str, metrics: Mapping[str, Column], rules: Mapping[str, Callable[[Mapping[str, object]], bool]]) -> dict[str, object]:
    """Writes ``df`` to ``path``, which must not exist, if all ``rules`` hold on its ``metrics``; returns these.

    Metrics of an empty table are those of no rows: counts are 0 and all others null, which rules must expect.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(conf)
    if fs.exists(place):
        raise FileExistsError(path)
    seen, ours = Observation(), jvm.org.apache.hadoop.fs.Path(f"{path}.writing-{uuid.uuid4().hex}")
    try:
        df.observe(seen, *(c.alias(name) for name, c in metrics.items())).write.parquet(ours.toString())
        found = seen.get
        failed = [name for name, rule in rules.items() if not rule(found)]
        if failed:
            raise Refused(failed, found)
        if not fs.rename(ours, place):
            raise FileExistsError(path)
        return found
    finally:
        fs.delete(ours, True)
