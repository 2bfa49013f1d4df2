"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid

from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: list[str] = []
#: All tables of this process, for its end; and those of each thread, so that queries in several threads only drop their own.
_made: set[str] = set()
_here = threading.local()


def _own() -> list[str]:
    if not hasattr(_here, "paths"):
        _here.paths = []
    return _here.paths


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where that is unset and driver and executors are one process."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="attestry-"))
        atexit.register(shutil.rmtree, _own_dir[0], True)
    return f"file://{_own_dir[0]}"


def materialize(df: DataFrame) -> DataFrame:
    """Writes ``df`` to a table in the shared folder and reads it back: cuts lineage and survives lost executors.

    Tables go when the process ends, or by ``drop_tables``.
    """
    path = f"{shared_dir(df.sparkSession)}/attestry/{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_delete_all)
    _made.add(path)
    _own().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tables() -> int:
    """How many tables this thread has: a mark for ``drop_tables``."""
    return len(_own())


def drop_tables(since: int = 0, last: int = 0) -> None:
    """Deletes this thread's tables made since a mark, but for the ``last`` ones; what still reads them fails afterwards."""
    paths = _own()
    gone = paths[since : len(paths) - last]
    del paths[since : len(paths) - last]
    _delete(gone)


def _delete_all() -> None:
    _delete(list(_made))


def _delete(paths: list[str]) -> None:
    jvm = SparkContext._jvm
    _made.difference_update(paths)
    if jvm is None:
        return
    try:
        conf = jvm.org.apache.hadoop.conf.Configuration() if SparkContext._active_spark_context is None else SparkContext._active_spark_context._jsc.hadoopConfiguration()
        for path in paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
    except (Py4JError, OSError):  # the engine has ended before: whoever owns the folder empties it
        pass


def numbered(df: DataFrame, *order: Column, name: str = "number") -> DataFrame:
    """``df`` with a number from 1 on in the given order: by ranges of it, never in one task.

    Rows are numbered inside the ranges that the engine cuts by sampled splitters; the ranges' sizes, a number each,
    are added up.  The ranges are written first, so that both steps see the same ones.
    """
    at = F.col("__at")
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    cut = materialize(cut.select("*", F.shiftright(at, 33).cast("int").alias("__range"), at.bitwiseAND((1 << 33) - 1).alias("__place")).drop("__at"))
    before, start = {}, 0
    for r in sorted(cut.groupBy("__range").count().collect()):
        before[r[0]], start = start, start + r[1]
    sizes = df.sparkSession.createDataFrame(list(before.items()), "__range int, __before long")
    # as many rows as there are ranges
    return cut.join(F.broadcast(sizes), "__range").withColumn(name, F.col("__before") + F.col("__place") + 1).drop("__range", "__place", "__before")
