"""Versioned control tables: whole snapshots, each committed by one atomic rename, and histories with validity.

A table is a folder of versions ``v-00000001``, ``v-00000002`` and so on.  A writer says which version it has read.  It
writes its snapshot beside them under a name of its own and renames it to the next number, which succeeds once only: of two
writers that read the same version the second fails with ``Conflict``, and its snapshot goes.  A reader sees a version
whole or not at all, and any version that is still there.

An empty folder, or none, is version 0, which can't be read.  Snapshots may be empty tables.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


class Conflict(RuntimeError):
    """Another writer has committed the version that this one meant to."""


def _folder(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, at.getFileSystem(conf), at


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all committed versions, in order."""
    _, _, fs, at = _folder(spark, path)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"v-(\d{8})", n)))


def current(spark: SparkSession, path: str) -> int:
    return max(versions(spark, path), default=0)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The latest snapshot, or that of a version."""
    return spark.read.parquet(f"{path}/v-{version if version is not None else current(spark, path):08d}")


def commit(df: DataFrame, path: str, read_version: int) -> int:
    """Writes ``df`` as the version after ``read_version`` and returns its number; ``Conflict`` if that exists."""
    spark = df.sparkSession
    jvm, conf, fs, at = _folder(spark, path)
    ours = f"{path}/.writing-{uuid.uuid4().hex}"
    df.write.parquet(ours)
    source, target = jvm.org.apache.hadoop.fs.Path(ours), jvm.org.apache.hadoop.fs.Path(f"{path}/v-{read_version + 1:08d}")
    try:
        if fs.makeQualified(at).toUri().getScheme() == "file":
            # the system's rename refuses a folder that has files, and every snapshot has one
            local = lambda p: jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
            options = spark.sparkContext._gateway.new_array(jvm.java.nio.file.CopyOption, 1)
            options[0] = jvm.java.nio.file.StandardCopyOption.ATOMIC_MOVE
            jvm.java.nio.file.Files.move(local(source), local(target), options)
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), conf).rename(source, target, none)
    except Py4JJavaError as e:
        fs.delete(source, True)
        if not fs.exists(target):
            raise
        raise Conflict(f"version {read_version + 1} of {path} exists") from e
    return read_version + 1


def expire(spark: SparkSession, path: str, keep: int = 10) -> list[int]:
    """Deletes all but the last ``keep`` versions, and returns the numbers of those deleted."""
    jvm, _, fs, _ = _folder(spark, path)
    gone = versions(spark, path)[: -keep or None]
    for n in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/v-{n:08d}"), True)
    return gone


def opened(rows: DataFrame, at: Column) -> DataFrame:
    """``rows`` as a history: valid from ``at`` on."""
    return rows.withColumns({"valid_from": at, "valid_to": F.lit(None).cast(rows.select(at.alias("t")).schema["t"].dataType)})


def advanced(history: DataFrame, incoming: DataFrame, keys: list[str], at: Column) -> DataFrame:
    """``history`` after ``incoming``, the whole state at ``at``: rows that changed or went are closed, new and changed ones opened, all others stay.

    ``history`` has the columns of ``incoming``, valid_from and valid_to (null: still valid).  Keys are given and unique in ``incoming``;
    values compare null-safe.
    """
    values = [c for c in incoming.columns if c not in keys]
    mark = lambda p: F.struct(*(F.col(f"{p}.{c}") for c in values)) if values else F.lit(1)
    now, then = history.filter("valid_to is null").alias("o"), incoming.alias("n")
    same = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    both = now.join(then, same, "full_outer")
    was, is_ = F.col(f"o.{keys[0]}").isNotNull(), F.col(f"n.{keys[0]}").isNotNull()
    stays = was & is_ & mark("o").eqNullSafe(mark("n"))
    old = both.filter(was).select(*(F.col(f"o.{c}") for c in [*keys, *values, "valid_from"]), F.when(~stays, at).alias("valid_to"))
    new = both.filter(is_ & ~stays).select(*(F.col(f"n.{c}") for c in [*keys, *values]))
    return history.filter("valid_to is not null").select(old.columns).unionByName(old).unionByName(opened(new, at))


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """The rows that were valid at a moment, without their validity."""
    return history.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))).drop("valid_from", "valid_to")


def state_history(events: DataFrame, key: str, order: list[str], state: str) -> DataFrame:
    """key, state, valid_from, valid_to and events: the stretches of equal states of each key's events in ``order``, its first column the time.

    The last stretch of a key is open.  A key's events are one window, so keys of very many events want a coarser state first.
    """
    own = Window.partitionBy(key).orderBy(*order)
    begins = events.withColumn("__new", (~F.lag(state).over(own).eqNullSafe(F.col(state)) | (F.row_number().over(own) == 1)).cast("int"))
    runs = begins.withColumn("__run", F.sum("__new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy(key, "__run", state).agg(F.min(order[0]).alias("valid_from"), F.count("*").alias("events"))
    return spans.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy(key).orderBy("__run"))).select(key, state, "valid_from", "valid_to", "events")
