"""Folder digests by path: a change rehashes its own branch, and two trees differ where their digests do.

A file's digest is the SHA-256 of its content; a folder's is that over its members in order of name: name, a zero byte, digest
and a line feed each.  Folders are made level by level from the deepest one, so that no task holds more than one folder's
members: names and digests only.  The root's path is the empty text.

Paths have no slash at either end; null paths are no files, null contents are empty; of rows that repeat a path the
smallest digest counts; an empty table has no folders at all, not even a root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, r"(^|/)[^/]*$", "")


def digests(files: DataFrame) -> DataFrame:
    """path, folder, digest and members (files below, 1 for a file) of all files and folders of ``files`` (path, content)."""
    content = F.coalesce(F.col("content").cast("binary"), F.lit("").cast("binary"))
    leaves = files.filter("path is not null and path <> ''").groupBy("path").agg(F.min(F.sha2(content, 256)).alias("digest"))
    leaves = materialize(leaves.select("path", F.lit(False).alias("folder"), "digest", F.lit(1).cast("long").alias("members"), F.size(F.split("path", "/")).alias("depth")))
    deepest = leaves.agg(F.max("depth")).first()[0] or 0
    levels, above = [leaves], None
    for depth in range(deepest, 0, -1):
        here = leaves.filter(F.col("depth") == depth)
        here = here if above is None else here.unionByName(above)
        line = F.struct(F.substring_index("path", "/", -1).alias("n"), "digest", "folder")
        folders = here.groupBy(_parent(F.col("path")).alias("up")).agg(F.array_sort(F.collect_list(line)).alias("t"), F.sum("members").alias("members"))
        body = F.array_join(F.transform("t", lambda x: F.concat(x["n"], F.lit("\u0000"), x["digest"], F.lit("\n"))), "")
        above = materialize(folders.select(F.col("up").alias("path"), F.lit(True).alias("folder"), F.sha2(body.cast("binary"), 256).alias("digest"), "members", F.lit(depth - 1).alias("depth")))
        levels.append(above)
    return reduce(DataFrame.unionByName, levels).drop("depth")


def tree_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """path, folder and change (added, removed or changed) of all that differs between two ``digests``; equal branches don't appear."""
    old = before.select("path", "folder", F.col("digest").alias("was"))
    new = after.select("path", "folder", F.col("digest").alias("is"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").otherwise("changed")
    return old.join(new, ["path", "folder"], "full_outer").filter("not (was <=> is)").select("path", "folder", change.alias("change"))
