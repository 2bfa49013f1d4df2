"""Versions, histories, streams of runs, folder digests, chunks, gated writes, sketches and cubes."""

import hashlib
import random
import threading
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from attestry.operators import blocks, chapters, concepts, sketches, trees
from attestry.sources import gated, versions
from attestry.streaming import runs


def _path(tmp_path, name):
    return f"file://{tmp_path}/{name}"


# versions


def test_versions_are_read_whole_and_as_of(spark, tmp_path):
    path = _path(tmp_path, "states")
    assert versions.versions(spark, path) == [] and versions.current(spark, path) == 0
    assert versions.commit(spark.range(3), path, 0) == 1
    assert versions.commit(spark.range(5), path, 1) == 2
    assert versions.commit(spark.range(0), path, 2) == 3
    assert [versions.read(spark, path, n).count() for n in (1, 2, 3)] == [3, 5, 0] and versions.read(spark, path).count() == 0
    assert versions.expire(spark, path, 2) == [1] and versions.versions(spark, path) == [2, 3]


def test_of_two_writers_one_fails_cleanly(spark, tmp_path):
    path, out = _path(tmp_path, "race"), []
    versions.commit(spark.range(1), path, 0)

    def writer(n):
        try:
            out.append(versions.commit(spark.range(n), path, 1))
        except versions.Conflict:
            out.append("conflict")

    threads = [threading.Thread(target=writer, args=(n,)) for n in (10, 20, 30)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(map(str, out)) == ["2", "conflict", "conflict"]
    assert versions.read(spark, path).count() in (10, 20, 30) and versions.versions(spark, path) == [1, 2]
    assert not [p for p in (tmp_path / "race").iterdir() if p.name.startswith(".writing")]
    with pytest.raises(versions.Conflict):
        versions.commit(spark.range(1), path, 0)
    assert versions.commit(spark.range(7), path, versions.current(spark, path)) == 3


def test_histories_keep_what_was_valid(spark):
    frame = lambda rows: spark.createDataFrame(rows, "slug string, status string, n long")
    states = [[("a", "READY", 1), ("b", "DONE", 2), ("c", None, None)], [("a", "READY", 1), ("b", "FAILED", 2), ("d", "NEW", 4)], [("a", "READY", 9), ("b", "FAILED", 2), ("c", None, None), ("d", None, 4)], []]
    history = versions.opened(frame(states[0]), F.lit(10))
    for k, rows in enumerate(states[1:], 2):
        history = versions.advanced(history, frame(rows), ["slug"], F.lit(10 * k))
    for k, rows in enumerate(states, 1):
        assert sorted(map(tuple, versions.as_of(history, F.lit(10 * k + 5)).collect())) == sorted(rows), k
    assert versions.as_of(history, F.lit(5)).count() == 0
    assert history.filter("slug = 'a'").count() == 2 and history.filter("slug = 'c'").count() == 2


def test_state_history_of_ties_and_nulls(spark):
    rows = [("u", 1, 1, "x"), ("u", 2, 2, "x"), ("u", 3, 3, None), ("u", 3, 4, None), ("u", 5, 5, "x"), ("v", 1, 6, None)]
    got = versions.state_history(spark.createDataFrame(rows, "k string, t long, i long, s string"), "k", ["t", "i"], "s")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("u", "x", 1, 3, 2), ("u", None, 3, 5, 2), ("u", "x", 5, None, 1), ("v", None, 1, None, 1)], key=repr)


# streams


@pytest.fixture(scope="module")
def late_events(spark, tmp_path_factory):
    """Events in files by order of arrival: up to ten minutes late, some twice."""
    pick, start = random.Random(2), datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        at = start + timedelta(minutes=pick.randrange(0, 3000))
        rows.append((i, pick.choice(["u1", "u2", "u3"]), at))
    rows.sort(key=lambda r: r[2] + timedelta(minutes=pick.randrange(0, 10)))
    rows += []
    repeated = [r for r in rows for _ in range(2 if r[0] % 5 == 0 else 1)]
    folder = tmp_path_factory.mktemp("arrivals")
    for k in range(0, len(repeated), 60):
        pd.DataFrame(repeated[k : k + 60], columns=["event_id", "user", "at"]).astype({"at": "datetime64[us]"}).to_parquet(folder / f"part-{k:05d}.parquet")
    return f"file://{folder}", rows


def test_stream_of_late_and_repeated_events_closes_the_runs_of_the_table(spark, late_events, tmp_path):
    path, rows = late_events
    schema = "event_id long, user string, at timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    first = runs.first_events(stream, "event_id", "at", "20 minutes")
    out = str(tmp_path / "runs")
    query = runs.stale_runs(first, "user", "at", 1800).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(out).collect()}
    table = spark.createDataFrame(rows, schema)
    want = {tuple(r) for r in runs.run_spans(table, "user", "at", 1800).collect()}
    last = max(int(r[2].timestamp()) for r in rows) * 1_000_000
    assert got <= want and len(got) > 20
    # what is not closed yet ends too near to the last watermark
    assert all(r[2] + (1800 + 1200 + 700) * 1_000_000 >= last for r in want - got)


def test_repeated_events_are_dropped(spark, late_events, tmp_path):
    path, rows = late_events
    stream = spark.readStream.schema("event_id long, user string, at timestamp").option("maxFilesPerTrigger", 2).parquet(path)
    out = str(tmp_path / "once")
    runs.first_events(stream, "event_id", "at", "20 minutes").writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == sorted(r[0] for r in rows)


def test_runs_of_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, datetime(2024, 1, 1)), ("a", datetime(2024, 1, 1)), ("a", datetime(2024, 1, 1))], "k string, t timestamp")
    assert [(r.k, r.events) for r in runs.run_spans(df, "k", "t", 10).collect()] == [("a", 2)]
    assert runs.run_spans(df.limit(0), "k", "t", 10).count() == 0


# folders


def _digests(files):
    out, folders = {}, {}
    for p, c in files.items():
        out[p] = hashlib.sha256((c or "").encode()).hexdigest()
        parts = p.split("/")
        for k in range(len(parts)):
            folders.setdefault("/".join(parts[:k]), set()).add("/".join(parts[: k + 1]))
    for f in sorted(folders, key=lambda f: -(f.count("/") + 1 if f else 0)):
        out[f] = hashlib.sha256("".join(f"{m.split('/')[-1]}\0{out[m]}\n" for m in sorted(folders[f], key=lambda m: m.split("/")[-1])).encode()).hexdigest()
    return out


def test_folder_digests_and_differences(spark):
    old = {"a/x": "1", "a/y": "2", "b/c/d/e": "3", "b/c/f": None, "top": "t", "same/one": "s", "same/two/three": "s"}
    new = {**old, "a/y": "changed", "b/g": "new"}
    del new["b/c/d/e"]
    made = [trees.digests(spark.createDataFrame([*f.items(), (None, "x"), ("top", "t")], "path string, content string").withColumn("digest", F.lit("own"))) for f in (old, new)]
    for files, df in zip((old, new), made):
        assert {r.path: r.digest for r in df.collect()} == _digests(files)
    assert {r.path: r.members for r in made[0].collect()}[""] == len(old)
    got = {(r.path, r.change) for r in trees.tree_diff(*made).collect()}
    assert got == {("", "changed"), ("a", "changed"), ("a/y", "changed"), ("b", "changed"), ("b/g", "added"), ("b/c", "changed"), ("b/c/d", "removed"), ("b/c/d/e", "removed")}
    assert trees.digests(spark.createDataFrame([], "path string, content string")).count() == 0


# chunks


def _chunks(sizes, pages, most):
    out, done = [], 0
    while done < len(sizes):
        n = min(len(sizes) - done, pages)
        while sum(sizes[done : done + n]) > most and n > 1:
            n = max(1, (n - 1) // 2)
        out.append((done + 1, done + n, sum(sizes[done : done + n])))
        done += n
    return out


def test_chunks_halve_until_they_fit(spark):
    pick = random.Random(1)
    books = {b: [pick.choice((1, 5, 20, 90, 300)) for _ in range(n)] for b, n in (("a", 1), ("b", 257), ("c", 40), ("d", 100))}
    books["e"] = [500, 1, None, 1]
    rows = [(b, i, s) for b, sizes in books.items() for i, s in enumerate(sizes)] + [(None, 1, 1)]
    df = spark.createDataFrame(rows, "book string, page long, bytes long")
    got = {}
    for r in chapters.chunk_plan(df, "book", "page", "bytes", 30, 400).orderBy("book", "chunk").collect():
        got.setdefault(r.book, []).append((r["first"], r["last"], r["bytes"]))
        assert r.too_large == (r["bytes"] > 400) and r.chunk == len(got[r.book])
    assert got == {b: _chunks([s or 0 for s in sizes], 30, 400) for b, sizes in books.items()}
    assert chapters.chunk_plan(df.limit(0), "book", "page", "bytes").count() == 0


# gates


def test_gated_write_measures_while_it_writes(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.range(1000, numPartitions=4).mapInArrow(counted, "id long")
    metrics, rules = {"n": F.count("*"), "most": F.max("id")}, {"enough": lambda m: m["n"] >= 10, "small": lambda m: m["most"] is not None and m["most"] < 5000}
    assert gated.gated_write(df, _path(tmp_path, "kept"), metrics, rules) == {"n": 1000, "most": 999}
    assert reads.value == 1000 and spark.read.parquet(_path(tmp_path, "kept")).count() == 1000
    with pytest.raises(gated.Refused) as refused:
        gated.gated_write(spark.range(6000), _path(tmp_path, "refused"), metrics, rules)
    assert refused.value.failed == ["small"] and refused.value.metrics["n"] == 6000
    with pytest.raises(gated.Refused):
        gated.gated_write(spark.range(0), _path(tmp_path, "refused"), metrics, rules)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["kept"]
    with pytest.raises(FileExistsError):
        gated.gated_write(spark.range(20), _path(tmp_path, "kept"), metrics, rules)


# sketches


def test_sketches_of_batches_are_within_their_errors(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("k"), F.concat(F.lit("w"), F.pmod(F.xxhash64("id"), 7000 * (F.col("id") % 3 + 1))).alias("w"), (F.col("id") * 7919 % 60_000).alias("n"))
    batches = [sketches.sketched(df.filter(f"n % 5 = {b}"), ["k"], "w", "n") for b in range(5)]
    every = batches[0]
    for b in batches[1:]:
        every = every.unionByName(b)
    exact = {r.k: r for r in df.groupBy("k").agg(F.count("*").alias("rows"), F.count_distinct("w").alias("d")).collect()}
    values = {k: sorted(r.n for r in df.filter(f"k = {k}").collect()) for k in range(3)}
    for r in sketches.estimates(sketches.merged(every, ["k"]), ["k"]).collect():
        assert r.rows == exact[r.k].rows and abs(r.n_distinct - exact[r.k].d) < 0.06 * exact[r.k].d
        for share, q in ((0.1, r.q10), (0.5, r.q50), (0.9, r.q90)):
            rank = sum(v <= q for v in values[r.k]) / len(values[r.k])
            assert abs(rank - share) < 0.03


def test_count_min_never_undercounts(spark):
    pick = random.Random(3)
    rows = [(pick.choice("ab"), f"w{min(pick.randrange(4000), pick.randrange(4000))}") for _ in range(20_000)] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, w string")
    halves = [sketches.counters(df.filter(c), ["k"], "w") for c in ("w < 'w2'", "w >= 'w2'")]
    matrix = sketches.merged_counters(halves[0].unionByName(halves[1]), ["k"])
    true = {}
    for k, w in rows:
        true[k, w] = true.get((k, w), 0) + 1
    asked = spark.createDataFrame([(k, f"w{i}") for k in "ab" for i in range(0, 4500, 7)], "k string, w string")
    got = {(r.k, r.w): r.at_most for r in sketches.looked_up(matrix, asked, ["k"], "w").collect()}
    bound = 2 * 10_300 / sketches.WIDTH
    assert all(n >= true.get(x, 0) for x, n in got.items()) and sum(n > true.get(x, 0) + bound for x, n in got.items()) <= 0.06 * len(got)


# cubes, tallies, ranks


def test_cube_tells_sums_from_nulls(spark):
    rows = [("s", 1, "A", 10), ("s", 1, "A", 10), ("s", 2, "B", 11), (None, 1, "A", 12)]
    got = {(r.slug, r.chapter, r.category, r.level): (r.blocks, r.files) for r in blocks.evidence_cube(spark.createDataFrame(rows, "slug string, chapter long, category string, file long"), "slug", "chapter").collect()}
    assert got[None, None, None, 7] == (4, 3) and got[None, None, None, 3] == (1, 1) and got["s", None, None, 3] == (3, 2)
    assert got["s", None, "A", 2] == (2, 1) and got[None, 1, "A", 0] == (1, 1) and len(got) == 3 + 3 + 2 + 1


def test_tallies_score_as_lists_do(spark):
    pick = random.Random(7)
    some = lambda: [f"x{pick.randrange(9)}" for _ in range(pick.choice((0, 0, 1, 2)))]
    rows = [(pick.choice(["cat", "cats", "dog", "s", "", "big-dog", "big-dogs"]), None, pick.choice((1, 2, 3, None)), pick.choice((None, 0.3, 0.9)), pick.choice((None, 1.0, 3.0, 5.0)), i, some(), None if i % 3 else some()) for i in range(60)]
    df = spark.createDataFrame(rows, "slug string, name string, chapter long, confidence double, density double, ord long, definitions array<string>, examples array<string>")
    lists = {r.slug: r.score for r in concepts.scored(concepts.fold(concepts.merge(df))).collect()}
    assert {r.slug: r.score for r in concepts.scored(concepts.tallied(df)).collect()} == lists


def test_ranks_of_one_common_beginning_and_one_score(spark):
    df = spark.range(4000).select(F.concat(F.lit("part-"), F.col("id") * 7 % 4001 + 10000).alias("slug"), F.when(F.col("id") % 50 == 0, 17).otherwise(9).alias("score"))
    got = {r.slug: r["rank"] for r in concepts.ranked(df).collect()}
    order = sorted((-r.score, r.slug) for r in df.collect())
    assert got == {s: k + 1 for k, (_, s) in enumerate(order)}


def test_near_duplicates_of_short_and_empty_forms(spark):
    slugs = ["s", "a", "ab", "cab", "xaby", "other", "others", "s-s"]
    df = spark.createDataFrame([(x,) for x in slugs], "slug string")
    found = concepts.near_duplicates(df)
    got = {(r.a, r.b): r.reason for r in found.collect()}
    assert got["ab", "cab"] == got["ab", "xaby"] == got["a", "ab"] == "one slug contains the other" and got["other", "others"].startswith("identical")
    assert ("ab", "s") in got and ("s", "xaby") in got and ("a", "other") not in got


def test_near_duplicates_read_their_source_once(spark, tmp_path):
    path = str(tmp_path / "slugs")
    spark.createDataFrame([("moon-bases",), ("moon-base",), ("sun",)], "slug string").write.parquet(path)
    found = concepts.near_duplicates(spark.read.parquet(path))
    assert not any(path in f for f in found.inputFiles())
    assert [tuple(r) for r in found.collect()] == [("moon-base", "moon-bases", "identical after plural/possessive normalization")]


@pytest.mark.parametrize("name", ["near_duplicates", "known_duplicates", "artifact_filter", "selection_check"])
def test_slugs_of_order_lines_are_made_once(spark, tmp_path, name):
    from attestry.plans import concept_queries

    lines = [(1, 1, 7, 0.1, 5.0, "1995-02-03"), (1, 2, 8, 0.0, 6.0, "1995-03-03")]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_discount double, l_quantity double, l_shipdate string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(7, "red ring"), (8, "old plate")], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    found = concept_queries.QUERIES[name](spark, str(tmp_path))
    assert found.count() and not any("lineitem" in f or "part.parquet" in f for f in found.inputFiles())
