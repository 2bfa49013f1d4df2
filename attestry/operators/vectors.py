"""Nearest neighbours of vectors by an inverted file of coarse cells.

Cells come from k-means on a bounded sample (``SAMPLE`` vectors, the smallest by a hash of their ids); every
vector is then put into the cell of its nearest centre.  A query meets the vectors of the cells it probes: ``probes``
nearest ones, or as many as reach a wanted ``recall`` on a sample of the queries, or, without either, all that can hold a neighbour: cells are first probed ``FIRST``, the least
similarity found there bounds the distance, and by the triangle inequality any cell whose edge lies farther has none.
The last way is exact.

Likeness is the cosine, rounded to six digits; equally like ones are in order of their ids.  Cells are dealt into blocks
of at most ``BLOCK`` vectors and ``BLOCK`` queries, so that a cell with a third of all vectors is many tasks; each block
gives its best ``k`` of a query, which are merged.  The driver holds the centres: at most ``CELLS`` of them, whatever the
number of vectors.  A task's Python holds one block's vectors and at most ``HELD`` likenesses of them; a query's cells
leave it as a list, which the engine takes apart, so that no batch holds a vector once for each cell.

Null, empty and zero vectors, and those of another length than most have, neither have neighbours nor are any.  A vector is
no neighbour of its own id.  Of queries that repeat an id one counts; of equally like vectors that repeat an id each may be found.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import materialize

#: Vectors that the centres are fitted on at most.
SAMPLE = 20_000
CELLS = 1024
ROUNDS = 6
#: Cells that are probed first for the bound of exact search.
FIRST = 2
#: Queries on which the number of probes is measured at most.
CALIBRATING = 200
BLOCK = 1 << 14
#: Likenesses that a task holds at once at most.
HELD = 1 << 20
DIGITS = 6


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64).reshape(len(rows), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vectors: DataFrame) -> DataFrame:
    """id and vector, without nulls, zeros and odd lengths; ``vectors`` has id and vector."""
    own = vectors.select("id", F.col("vector").cast("array<double>").alias("vector")).filter("id is not null and size(vector) > 0")
    own = own.filter("aggregate(vector, 0D, (a, x) -> a + x * x) > 0")
    length = own.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").select("n").first()
    return own.filter(F.size("vector") == (length.n if length else 0))


def centres(vectors: DataFrame, cells: int | None = None, sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of unit length, from a sample of ``usable`` vectors; as many as the square root of their number."""
    n = vectors.count()
    if not n:
        return np.zeros((0, 0))
    cells = cells or max(1, min(CELLS, math.isqrt(n)))
    x = _unit([r.vector for r in vectors.orderBy(F.xxhash64("id"), "id").limit(sample).collect()])
    c = np.unique(x, axis=0)
    c = c[np.linspace(0, len(c) - 1, min(cells, len(c))).astype(int)]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 1e-9, total / np.maximum(size, 1e-9), c)
    return c


def _units(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of unit length from a column of lists of one length, at least one row."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    x = flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pieces(it: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of as many rows as have ``HELD`` likenesses to ``width`` centres."""
    step = max(1, HELD // width)
    for b in it:
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def celled(vectors: DataFrame, c: np.ndarray) -> DataFrame:
    """id, vector, cell and far (the distance from the cell's centre) of ``usable`` vectors."""
    shared = vectors.sparkSession.sparkContext.broadcast(c)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(it, len(shared.value)):
            like = _units(b.column(1)) @ shared.value.T
            own = like.argmax(axis=1)
            far = np.sqrt(np.maximum(0, 2 - 2 * like[np.arange(len(own)), own]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(own.astype(np.int32)), pa.array(far)], ["id", "vector", "cell", "far"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(batches, f"id {kind}, vector array<double>, cell int, far double")


def _in_cells(queries: DataFrame, width: int, mark: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """id, vector and cell: each query once for each of its cells; ``mark`` tells them for a piece, a row a query and a column a cell."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(it, width):
            may = mark(b)
            ends = np.concatenate([[0], np.cumsum(may.sum(axis=1))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(ends, np.nonzero(may)[1].astype(np.int32))], ["id", "vector", "cells"])

    kind = queries.schema["id"].dataType.simpleString()
    return queries.mapInArrow(batches, f"id {kind}, vector array<double>, cells array<int>").select("id", "vector", F.explode("cells").alias("cell"))


def _nearest(like: np.ndarray, n: int) -> np.ndarray:
    """The places of the ``n`` nearest centres of each row; of equally near ones the first."""
    return np.argsort(-like, axis=1, kind="stable")[:, :n]


def probed(queries: DataFrame, c: np.ndarray, probes: int) -> DataFrame:
    """id, vector and cell: each query once for each of its ``probes`` nearest cells."""
    shared = queries.sparkSession.sparkContext.broadcast(c)

    def mark(b: pa.RecordBatch) -> np.ndarray:
        like = _units(b.column(1)) @ shared.value.T
        may = np.zeros(like.shape, bool)
        np.put_along_axis(may, _nearest(like, probes), True, axis=1)
        return may

    return _in_cells(queries, len(c), mark)


def left_to_probe(queries: DataFrame, c: np.ndarray, radius: np.ndarray, first: int) -> DataFrame:
    """id, vector and cell: beyond the ``first`` nearest cells, those that a neighbour may be in; ``queries`` has id, vector and least (similarity)."""
    shared = queries.sparkSession.sparkContext.broadcast((c, radius))

    def mark(b: pa.RecordBatch) -> np.ndarray:
        centre, edge = shared.value
        like = _units(b.column(1)) @ centre.T
        reach = np.sqrt(np.maximum(0, 2 - 2 * (b.column(2).to_numpy(zero_copy_only=False) - 2 * 10.0**-DIGITS)))
        may = np.sqrt(np.maximum(0, 2 - 2 * like)) - edge[None, :] <= reach[:, None] + 1e-6
        np.put_along_axis(may, _nearest(like, first), False, axis=1)
        return may

    return _in_cells(queries.select("id", "vector", "least"), len(c), mark)


def _most_like(ids: np.ndarray, q: np.ndarray, others: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``ids``, places in ``others`` and similarities of the best ``k`` of each query; ``others`` are in order, as of equally like ones the first counts."""
    rows, found, likes = [], [], []
    step = max(1, HELD // len(others))
    for at in range(0, len(ids), step):
        unlike = np.round(q[at : at + step] @ x.T, DIGITS)
        np.negative(unlike, out=unlike)
        unlike[ids[at : at + step, None] == others[None, :]] = 9
        top = np.argsort(unlike, axis=1, kind="stable")[:, :k].copy()  # a view would keep the whole order
        row, like = np.repeat(np.arange(at, at + len(top)), top.shape[1]), -np.take_along_axis(unlike, top, axis=1).ravel()
        own = like > -9
        rows.append(row[own])
        found.append(top.ravel()[own])
        likes.append(like[own])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(likes)


def _met(asked: DataFrame, held: DataFrame, k: int, block: int) -> DataFrame:
    """id, neighbour and similarity: the best ``k`` in each block; ``asked`` and ``held`` have id, vector and cell."""
    size = held.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    parts = asked.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("slices"))
    sizes = F.broadcast(materialize(size.join(parts, "cell")))  # a row for each cell at most
    deal = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = held.join(sizes, "cell").select("cell", deal(F.col("blocks")).alias("block"), every("slices").alias("slice"), F.lit(False).alias("asks"), "id", "vector")
    seek = asked.join(sizes, "cell").select("cell", every("blocks").alias("block"), deal(F.col("slices")).alias("slice"), F.lit(True).alias("asks"), "id", "vector")

    def best(group: pa.Table) -> pa.Table:
        kind = group.schema.field("id").type
        seek, kept = group.filter(group["asks"]), group.filter(pc.invert(group["asks"]))
        if not seek.num_rows or not kept.num_rows:
            row = found = like = np.zeros(0, int)
            ids = others = seek["id"].to_numpy()
        else:
            ids, others = seek["id"].to_numpy(), kept["id"].to_numpy()
            order = np.argsort(others, kind="stable")
            others = others[order]
            row, found, like = _most_like(ids, _units(seek["vector"]), others, _units(kept["vector"])[order], k)
        return pa.table({"id": pa.array(ids[row], kind), "neighbour": pa.array(others[found], kind), "similarity": pa.array(like, pa.float64())})

    kind = held.schema["id"].dataType.simpleString()
    return rows.unionByName(seek).groupBy("cell", "block", "slice").applyInArrow(best, f"id {kind}, neighbour {kind}, similarity double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each id, which the engine cuts before and after the shuffle."""
    order = Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= k)


def probes_for(asked: DataFrame, held: DataFrame, c: np.ndarray, k: int, recall: float, block: int = BLOCK) -> int:
    """The fewest nearest cells that hold a share of ``recall`` of the true neighbours of a sample of queries.

    The sample's neighbours are looked for in all cells: ``CALIBRATING`` queries at most, whatever their number.
    """
    some = materialize(asked.orderBy(F.xxhash64("id"), "id").limit(CALIBRATING))
    found = _best(_met(probed(some, c, len(c)), held, k, block), k)
    cells = held.select(F.col("id").alias("neighbour"), "cell").dropDuplicates(["neighbour"])
    rows = found.join(cells, "neighbour").join(some.select("id", "vector"), "id").select("vector", "cell").collect()
    if not rows:
        return 1
    order = np.argsort(-(_unit([r.vector for r in rows]) @ c.T), axis=1, kind="stable")
    rank = np.sort(np.argmax(order == np.array([r.cell for r in rows])[:, None], axis=1))
    return int(rank[min(len(rank) - 1, math.ceil(recall * len(rank)))]) + 1


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, probes: int | None = None, recall: float | None = None, cells: int | None = None, block: int = BLOCK) -> DataFrame:
    """id, neighbour, similarity and rank: the ``k`` vectors most like each query; both tables have id and vector.

    Of ``probes`` cells, or of as many as reach ``recall`` on a sample of the queries; without either, exactly.
    """
    held = materialize(usable(vectors))
    c = centres(held, cells)
    asked = usable(queries).dropDuplicates(["id"])
    if not len(c):
        none = held.select("id", F.col("id").alias("neighbour"), F.lit(0.0).alias("similarity"), F.lit(0).cast("long").alias("rank"))
        return none.limit(0)
    held, asked = materialize(celled(held, c)), materialize(asked.filter(F.size("vector") == c.shape[1]))
    if recall is not None:
        probes = probes_for(asked, held, c, k, recall, block)
    first = min(probes or FIRST, len(c))
    found = materialize(_best(_met(probed(asked, c, first), held, k, block), k))
    if probes:
        return found
    edges = np.zeros(len(c))
    for r in held.groupBy("cell").agg(F.max("far").alias("far")).collect():  # a row for each cell
        edges[r.cell] = r.far
    # without k neighbours yet, any distance will do
    bound = found.groupBy("id").agg(F.min("similarity").alias("s"), F.count("*").alias("n"))
    least = F.when(F.col("n") >= k, F.col("s")).otherwise(-1.0)
    rest = asked.join(bound, "id", "left").select("id", "vector", F.coalesce(least, F.lit(-1.0)).alias("least"))
    more = _met(materialize(left_to_probe(rest, c, edges, first)), held, k, block)
    return _best(found.drop("rank").unionByName(more), k)
