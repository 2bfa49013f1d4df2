"""Nearness: vectors, reachability, cycles, ranges and states, against brute force and odd input."""

import random
import threading
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from attestry.operators import intervals, reach, vectors
from attestry.sources import scratch


def _brute(rows, ids, k):
    unit = {i: np.array(v, float) / np.linalg.norm(v) for i, v in rows}
    out = {}
    for q in ids:
        like = sorted((-round(float(unit[q] @ unit[i]), 6), i) for i in unit if i != q)
        out[q] = [i for _, i in like[:k]]
    return out


@pytest.fixture(scope="module")
def cloud():
    """Points in a few clusters, one of them with a third of all, many of them equal."""
    pick = np.random.default_rng(3)
    middle = pick.normal(size=(12, 16))
    rows = [(i, (middle[i % 12] + 0.3 * pick.normal(size=16)).tolist()) for i in range(400)]
    return rows + [(1000 + i, (middle[0] + (0 if i % 3 else 0.01 * (i % 7))).tolist()) for i in range(200)]


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.id, r["rank"])):
        out.setdefault(r.id, []).append(r.neighbour)
    return out


@pytest.mark.parametrize("block", [40, 1 << 14])
def test_exact_neighbours_are_those_of_all_pairs(spark, cloud, block):
    df = spark.createDataFrame(cloud, "id long, vector array<double>").withColumn("cell", F.lit("own"))
    got = _found(vectors.neighbours(df, df.filter("id % 20 = 0"), k=7, block=block))
    want = _brute(cloud, [i for i, _ in cloud if i % 20 == 0], 7)
    assert got == want


def test_neighbours_of_few_cells_have_a_recall_of_nine_tenths(spark, cloud):
    df = spark.createDataFrame(cloud, "id long, vector array<double>")
    asked = [i for i, _ in cloud if i % 20 == 0]
    got, want = _found(vectors.neighbours(df, df.filter("id % 20 = 0"), k=7, probes=6)), _brute(cloud, asked, 7)
    # equal vectors count by likeness
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in cloud}
    least = {q: round(float(unit[q] @ unit[want[q][-1]]), 6) for q in asked}
    hits = sum(round(float(unit[q] @ unit[i]), 6) >= least[q] for q in asked for i in got.get(q, []))
    assert hits >= 0.9 * 7 * len(asked)


def test_recall_over_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    rows = [(r.id, r.vector) for r in df.collect()]
    asked = [i for i, _ in rows if i % 20 == 0]
    got, want = _found(vectors.neighbours(df, df.filter("id % 20 = 0"), recall=0.95)), _brute(rows, asked, 10)
    assert sum(len(set(got[q]) & set(want[q])) for q in asked) >= 9 * len(asked)


def test_probes_are_measured_on_vectors_without_clusters(spark):
    """Where a few cells don't do, more are probed: uniform directions in 24 dimensions."""
    pick = np.random.default_rng(9)
    rows = [(i, pick.normal(size=24).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    asked = [i for i, _ in rows if i % 20 == 0]
    want = _brute(rows, asked, 10)
    share = lambda got: sum(len(set(got.get(q, [])) & set(want[q])) for q in asked) / (10 * len(asked))
    assert share(_found(vectors.neighbours(df, df.filter("id % 20 = 0"), probes=2))) < 0.6
    assert share(_found(vectors.neighbours(df, df.filter("id % 20 = 0"), recall=0.95))) >= 0.9


def test_neighbours_of_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, 2.0, 3.0]), (6, [0.0, 1.0]), (6, [0.0, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 0.1]), (8, [1.0, 0.1])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    got = _found(vectors.neighbours(df, df, k=2))
    assert got == {1: [7, 8], 6: [7, 8], 7: [8, 1], 8: [7, 1]}
    assert vectors.neighbours(df.limit(0), df.limit(0)).count() == 0


class _Captured:
    """A table that keeps what is to run on its batches."""

    def __init__(self, df):
        self.sparkSession, self.schema = df.sparkSession, df.schema

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def select(self, *columns):
        return self


def test_cells_of_queries_take_little_memory(spark):
    """A batch holds a query's vector once, whatever the number of its cells; the likenesses to all centres are made piece by piece."""
    pick = np.random.default_rng(5)
    x, c = pick.normal(size=(3000, 16)), pick.normal(size=(500, 16))
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array(x.tolist()), pa.array([0.5] * 3000)], ["id", "vector", "least"])
    df = spark.createDataFrame([(1, [0.0], 0.5)], "id long, vector array<double>, least double")
    for made in (vectors.probed(_Captured(df), c, 200), vectors.left_to_probe(_Captured(df), c, np.full(500, 2.0), 2)):
        tracemalloc.start()
        largest, total = 0, 0
        for out in made.run(iter([batch])):
            largest, total = max(largest, out.nbytes), total + out.num_rows
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert total == 3000 and largest < 8e6 and peak < 64e6


def test_likenesses_of_a_block_are_made_piece_by_piece():
    pick = np.random.default_rng(6)
    q, x = pick.normal(size=(700, 8)), pick.normal(size=(5000, 8))
    ids, others = np.arange(700), np.arange(5000)
    tracemalloc.start()
    row, found, like = vectors._most_like(ids, q, others, x, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48e6  # all at once are 28 MB and their order as much
    want = np.round(q @ x.T, 6)
    want[ids, ids] = -9
    order = np.argsort(-want, axis=1, kind="stable")[:, :3]
    assert np.array_equal(row, np.repeat(ids, 3)) and np.array_equal(found, order.ravel()) and np.allclose(like, np.take_along_axis(want, order, axis=1).ravel())


def _distances(edges, roots):
    far, step = {r: 0 for r in roots}, set(roots)
    while step:
        step = {b for a, b in edges if a in step and b is not None and b not in far}
        far |= {n: 1 + max(far.values()) for n in step}
    return far


def test_distances_orphans_and_limits(spark):
    edges = [("index", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("a", "b"), ("x", "y"), ("y", "x"), (None, "a"), ("a", None), ("z", "z"), ("b", "b")]
    df = spark.createDataFrame(edges, "src string, dst string").withColumn("node", F.lit("own"))
    roots = spark.createDataFrame([("index",), (None,), ("nowhere",)], "node string")
    got = {r.node: r.distance for r in reach.reachable(df, roots).collect()}
    assert got == _distances(edges, ["index", "nowhere"]) == {"index": 0, "nowhere": 0, "a": 1, "b": 2, "c": 3}
    assert {r.node for r in reach.reachable(df, roots, most=1).collect()} == {"index", "nowhere", "a"}
    pages = spark.createDataFrame([(p,) for p in ("index", "a", "b", "c", "x", "y", "z", "q", "q", None)], "node string")
    assert {(r.node, r.linked) for r in reach.orphans(pages, df, roots).collect()} == {("x", True), ("y", True), ("z", False), ("q", False)}
    assert reach.reachable(df, roots.limit(0)).count() == 0
    assert reach.reachable(df.limit(0), roots).count() == 2


def test_search_leaves_out_edges_it_can_not_come_to(spark, monkeypatch):
    """Pages that nothing leads to and that are no roots: their links are not read round by round, and count for what they lead to."""
    edges = spark.createDataFrame([("r", "a"), ("a", "b"), (None, "b"), *((f"lone{i}", "b") for i in range(50)), ("lone1", "c"), ("o", "o"), ("c", "a")], "src string, dst string")
    pages, walked, searched = edges.select(F.col("src").alias("node")), [], reach._searched
    monkeypatch.setattr(reach, "_searched", lambda links, *rest: walked.append(links) or searched(links, *rest))
    roots = spark.createDataFrame([("r",), (None,)], "node string")
    found = {(r.node, r.linked) for r in reach.orphans(pages, edges, roots).collect()}
    assert found == {*((f"lone{i}", False) for i in range(50)), ("o", False), ("c", True)}
    assert {(r.node, r.distance) for r in reach.reachable(edges, roots).collect()} == {("r", 0), ("a", 1), ("b", 2)}
    assert [sorted(tuple(r) for r in links.collect()) for links in walked] == [[("a", "b"), ("c", "a"), ("o", "o"), ("r", "a")]] * 2


def test_long_chain_is_walked_to_its_end(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(20)], "src long, dst long")
    got = {r.node: r.distance for r in reach.reachable(df, spark.createDataFrame([(0,)], "node long")).collect()}
    assert got == {i: i for i in range(21)}


def _cycles(edges):
    to = {}
    for a, b in edges:
        to.setdefault(a, set()).add(b)
    ahead = {}
    for n in to:
        seen, step = set(), set(to[n])
        while step:
            seen |= step
            step = {b for a in step for b in to.get(a, ())} - seen
        ahead[n] = seen
    out = set()
    for n in to:
        group = {m for m in ahead[n] if n in ahead.get(m, ())}
        if group:
            out.add((n, min(group), len(group)))
    return out


def test_cycles_are_the_strongly_connected_groups(spark):
    pick = random.Random(8)
    edges = [(pick.randrange(60), pick.randrange(60)) for _ in range(75)] + [(100, 100), (101, 102), (102, 103), (103, 101), (103, 104), (104, 105), (105, 104)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {(r.node, r.cycle, r["size"]) for r in reach.cycles(df).collect()}
    assert got == _cycles(edges) and any(s > 2 for _, _, s in got) and any(s == 1 for _, _, s in got)
    assert reach.cycles(df.limit(0)).count() == 0
    assert reach.cycles(spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long")).count() == 0


def test_points_meet_their_ranges_without_a_nested_loop(spark):
    pick = random.Random(4)
    # a third of all ranges and points share one key; lengths from 1 to very long
    ranges = [(pick.choice("aab"), s := pick.randrange(5000), s + pick.choice((1, 2, 7, 8, 9, 64, 500, 4000)), i) for i in range(300)]
    ranges += [("a", 10, None, 900), ("a", 30, 30, 901), ("a", 40, 20, 902), (None, 1, 5, 903), ("a", None, 5, 904), ("b", -50, 7, 905)]
    points = [(pick.choice("aabc"), pick.randrange(5200), i) for i in range(400)] + [("a", None, 900), (None, 3, 901), ("b", -50, 902), ("b", -51, 903), ("b", -1, 904)]
    p = spark.createDataFrame(points, "k string, at long, p long")
    r = spark.createDataFrame(ranges, "k string, start long, end long, r long")
    joined = intervals.in_ranges(p, r, ["k"])
    got = sorted((x.p, x.r) for x in joined.collect())
    want = sorted((p, r) for k, at, p in points for q, s, e, r in ranges if k is not None and k == q and at is not None and s is not None and s <= at < (e if e is not None else 1 << 60))
    assert got == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert intervals.in_ranges(p, r.limit(0), ["k"]).count() == 0
    assert intervals.in_ranges(p.limit(0), r, ["k"]).count() == 0


@pytest.mark.parametrize("width", [None, 10])
def test_states_as_of_an_event(spark, width):
    pick = random.Random(6)
    states = [(pick.choice("aaab"), pick.randrange(200), i, pick.choice((None, 150))) for i in range(60)] + [(None, 3, 900, None), ("a", None, 901, None)]
    events = [(pick.choice("aaabc"), pick.randrange(220), i) for i in range(200)] + [(None, 3, 900), ("a", None, 901)]
    s = spark.createDataFrame(states, "k string, since long, s long, until long")
    e = spark.createDataFrame(events, "k string, t long, e long")

    def last(k, t):
        own = [x for x in states if None not in (k, t, x[0], x[1]) and x[0] == k and x[1] <= t]
        return max(own, key=lambda x: (x[1], x[2]))if own else None

    got = sorted((r.e, r.state.s if r.state else None) for r in intervals.as_of(e, s.select("k", "since", "s", "until"), "k", "t", "since", width=width).collect())
    assert got == sorted((i, (x := last(k, t)) and x[2]) for k, t, i in events)
    got = sorted((r.e, r.state.s if r.state else None) for r in intervals.as_of(e, s, "k", "t", "since", width=width, until="until").collect())
    assert got == sorted((i, x[2] if (x := last(k, t)) and (x[3] is None or x[3] > t) else None) for k, t, i in events)
    assert intervals.as_of(e, s.limit(0), "k", "t", "since", width=width).filter("state is not null").count() == 0
    assert intervals.as_of(e.limit(0), s, "k", "t", "since", width=width).count() == 0


def test_threads_drop_only_their_own_tables(spark):
    here = scratch.materialize(spark.range(3))
    since = scratch.tables()

    def other():
        scratch.materialize(spark.range(5))
        scratch.drop_tables()

    thread = threading.Thread(target=other)
    thread.start()
    thread.join()
    assert scratch.tables() == since and here.count() == 3


def test_numbers_of_one_common_beginning(spark):
    df = spark.range(3000).select(F.concat(F.lit("part-"), F.col("id") * 7 % 3001).alias("slug"))
    got = [r.slug for r in scratch.numbered(df, F.col("slug")).orderBy("number").collect()]
    assert got == sorted(got) and len(got) == 3000


@pytest.mark.parametrize("few", [0, 1, 100])
def test_small_and_large_frontiers_reach_the_same(spark, monkeypatch, few):
    monkeypatch.setattr(reach, "FEW", few)
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "a"), (None, "e"), ("d", None), ("d", "f")], "src string, dst string")
    roots = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "node string")
    assert {tuple(r) for r in reach.reachable(edges, roots).collect()} == {("a", 0), ("z", 0), ("b", 1), ("c", 1), ("d", 2), ("f", 3)}


def test_orphans_read_their_edges_once(spark, tmp_path):
    path = str(tmp_path / "edges")
    spark.createDataFrame([("a", "b"), ("c", "d"), ("e", "e"), (None, "e")], "src string, dst string").write.parquet(path)
    pages = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "node string")
    found = reach.orphans(pages, spark.read.parquet(path), pages.filter("node = 'a'"))
    assert not any(path in f for f in found.inputFiles())
    assert {tuple(r) for r in found.collect()} == {("c", False), ("d", True), ("e", False)}
