"""Exact dedup, spelling variants and importance resampling against brute force and odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from attestry.llm import exact, resample, spelling
from attestry.llm.common import numbered

ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two  three"), (5, "one two three"), (5, "one two three"), (6, "A" * 200_000), (7, "A" * 200_000), (8, "é ß 漢字 𝒳   x"),
    (9, "ONE"), (None, "one"), (None, "no id"), (None, "no id"), (10, "word " * 5000), (11, " one"), (12, "one two three"),
]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    for name in ("norm", "hash", "head", "piece", "copies", "n", "keep_id", "word", "words", "score", "rank", "text_sha256"):
        df = df.withColumn(name, F.lit("own"))
    return df.cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


# exact dedup


def _groups(rows):
    """doc_id, keep_id, size, kept, digest by comparing all texts in a dictionary."""
    by = defaultdict(list)
    for d, t in rows:
        by[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    out = []
    for text, ids in by.items():
        ids.sort(key=lambda d: (d is not None, d))
        out += [(d, ids[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()) for k, d in enumerate(ids)]
    return sorted(out, key=repr)


def test_exact_groups_of_odd_texts(odd, empty):
    assert sorted(map(tuple, exact.groups(odd).collect()), key=repr) == _groups(ODD)
    assert exact.groups(empty).count() == 0
    assert exact.dedup(empty).count() == 0


def test_exact_dedup_keeps_one_row_of_each_text(odd):
    kept = exact.dedup(odd)
    assert kept.columns == odd.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    assert len(norm) == len(set(norm)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in ODD})
    assert sorted(d for d, _ in rows if d is not None) == [2, 3, 5, 6, 8, 9, 10, 11, 12][: len(rows)] or {d for d, _ in rows} >= {3, 5, 6, 8, 9, 10, 11, 12}
    assert {d for d, _ in rows} & {4, 7} == set()  # a null id is smaller than 4, and 6 than 7


def test_exact_large_group_is_cut_and_joined(spark):
    rows = [(i, "the same  text" if i % 3 else f"text {i}") for i in range(3000)] + [(i, "the\tsame text") for i in range(5000, 5600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own = docs.select("doc_id", exact.normalised().alias("norm")).select("doc_id", F.xxhash64("norm").alias("hash"), F.lit(1).alias("copies"))
    large = exact._large(own, 4).collect()
    assert len(large) == 1 and large[0].pieces >= 3
    made = exact.runs(docs, exact._large(own, 4))
    pieces = [r for r in made.collect() if r.norm is not None]
    assert len(pieces) == large[0].pieces and sum(r.n for r in pieces) == 2600
    assert sorted(map(tuple, exact.groups(docs).collect()), key=repr) == _groups(rows)


def test_exact_compares_texts_of_one_beginning_and_hash(spark, monkeypatch):
    """With one hash for all texts only the comparison in full can tell them apart."""
    monkeypatch.setattr(exact.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    rows = [(i, "x" * 40 + str(i % 4)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, exact.groups(docs).collect()), key=repr) == _groups(rows)


def test_exact_sort_moves_no_group_by_hash(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    plan = exact.runs(docs, spark.createDataFrame([], "hash long, pieces long"))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SortAggregate" in plan and "hashpartitioning" not in plan


# spelling


def _one_error(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] or a[k + 1 :] == b[k:] or a[k:] == b[k + 1 :]


def _variants(rows):
    count = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: k for w, k in count.items() if len(w) >= 6 and k >= 5}
    near = {w: [x for x in n if _one_error(w, x)] for w in n}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


@pytest.fixture(scope="module")
def prose():
    """Words with many variants, some of them frequent, of few letters, so that errors meet repeats."""
    pick = random.Random(5)
    base = ["aaaaaa", "aaaaaaa", "aabaab", "abcabc", "Gövernment", "letters", "Étrange", "straße" + "x", "abababab", "zzzzzzzzzz"]
    words = []
    for w in base:
        words += [w] * 160
        for _ in range(25):
            k, c = pick.randrange(len(w) + 1), pick.choice("abéz")
            words += [pick.choice((w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]))] * pick.choice((1, 4, 6, 30))
    words += ["chainaaa"] * 6 + ["chainaab"] * 45 + ["chainabb"] * 400  # a form of a form
    pick.shuffle(words)
    rows = [(i, " ".join(words[i * 20 : i * 20 + 20])) for i in range(len(words) // 20 + 1)]
    return rows + [(None, " ".join(["nothing1"] * 6)), (1, None), (2, ""), (3, "short words only")]


@pytest.mark.parametrize("held", [7, 1000])
def test_spelling_variants_are_those_of_all_pairs(spark, prose, held):
    docs = spark.createDataFrame(prose, "doc_id long, text string").withColumn("word", F.lit("own"))
    want = _variants(prose)
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] != r[1] for r in want if r[1])
    got = sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs, held=held).collect())
    assert got == want


def test_spelling_of_odd_input(odd, empty):
    assert spelling.variants(empty).count() == 0
    assert spelling.variants(odd).count() == 0  # the long run occurs twice, and no other is long enough


def test_spelling_pairs_come_once_from_one_half(spark):
    table = spark.createDataFrame([("abcdef", 9), ("abcdeef", 5), ("abcddef", 5), ("xbcdef", 7), ("abcdex", 7)], "word string, n long")
    pairs = [(r.word, r.near) for r in spelling.near_words(table, 2).collect()]
    assert len(pairs) == len(set(pairs))
    words = [r.word for r in table.collect()]
    assert sorted(pairs) == sorted((a, b) for a in words for b in words if _one_error(a, b))


def test_spelling_hot_beginning_is_dealt_over_tasks(spark):
    words = sorted({"commonstart" + "".join(random.Random(i).choices("abc", k=6)) for i in range(300)})
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = sorted((r.word, r.near) for r in spelling.near_words(table, 8).collect())
    assert got == sorted((a, b) for a in words for b in words if _one_error(a, b))


def test_automaton_is_minimal_and_numbers_words():
    words = sorted({"".join(random.Random(i).choices("ab", k=8)) for i in range(120)} | {"tops", "taps", "top", "tap"})
    a = spelling.Automaton(words)
    assert [a._exact(a.root, 0, w) for w in words] == list(range(len(words)))
    assert a._exact(a.root, 0, "to") == -1
    # no two states accept the same ends
    ends = {}
    for s in range(len(a.next)):
        ends[s] = frozenset({""} if a.ends[s] else ()) | {c + e for c, t in a.next[s].items() for e in ends[t]}
    assert len(set(ends.values())) == len(ends)
    assert len(a.next) < sum(map(len, words)) / 2


# resampling


def _drawn(rows, items, percent=10, least=20):
    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))
    bucket = lambda w: zlib.crc32(w.encode()) % 10000
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(map(bucket, words(x)))
    for x in items:
        t.update(map(bucket, words(x)))
    big_s, big_t = float(sum(s.values())), float(sum(t.values()))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10000) / ((s[b] + 1.0) * (big_t + 10000))))
    out = []
    for d, x in rows:
        ws = words(x)
        weight = sum(gain(bucket(w)) for w in ws)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(ws), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    may = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is not None, r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(may[: percent * len(may) // 100])}
    return sorted(((*r, rank.get(id(r))) for r in out), key=repr)


def test_resampling_by_the_definition(spark):
    pick = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "漢字", "Wort"]
    rows = [(i, " ".join(pick.choices(vocabulary, k=pick.choice((5, 19, 20, 21, 60))))) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(1000, 1200)] + [(None, rows[8][1]), (2000, None), (2001, "")]
    items = [" ".join(vocabulary[:40])] * 5 + [None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("weight", F.lit("own"))
    target = spark.createDataFrame([(x,) for x in items], "text string")
    got = resample.query(docs, target)
    assert sorted(map(tuple, got.collect()), key=repr) == _drawn(rows, items)
    chosen = resample.drawn(docs, target)
    assert chosen.columns == docs.columns
    assert sorted(r.doc_id for r in chosen.collect()) == sorted(r.doc_id for r in got.filter("rank is not null").collect())


def test_resampling_of_odd_input(spark, odd, empty):
    target = spark.createDataFrame([("one two",)], "text string")
    assert resample.query(odd, target).count() == len(ODD)
    assert resample.query(empty, target).count() == 0
    none = resample.query(odd, target.limit(0))
    assert none.count() == len(ODD) and none.filter("rank is not null").count() == 0


def test_resampling_counts_longer_features():
    n, runs = resample.features("A b-c d", 3)
    assert n == 4 and runs == [b"a", b"b", b"c", b"d", b"a b", b"b c", b"c d", b"a b c", b"b c d"]


def test_identical_texts_are_counted_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "same words here") for i in range(50)] + [(99, "other")], "doc_id long, text string")
    texts = docs.groupBy("text").count()
    assert resample.bucketed(texts.select("text", F.col("count").alias("copies"))).count() == 2
    counted = resample.bucketed(texts.select("text", F.col("count").alias("copies")))
    assert resample.totals(counted).sum() == 151


def test_numbers_follow_the_order_over_all_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x"), (F.col("id") % 3).alias("y"))
    got = [(r.y, r.x) for r in numbered(df, F.col("y").desc(), F.col("x")).orderBy("number").collect()]
    assert got == sorted(got, key=lambda p: (-p[0], p[1]))
    assert sorted(r.number for r in numbered(df, F.col("y").desc(), F.col("x")).collect()) == list(range(1, 5001))
    assert np.array_equal(resample.gains(np.zeros(3), np.zeros(3)), np.zeros(3))
