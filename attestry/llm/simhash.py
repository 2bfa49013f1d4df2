"""SimHash near-duplicates by a binary-trie self-join.

A text's ASCII letters are lower-cased, its words (runs of anything but
ASCII white space) form four-word shingles, repeats included, and each
shingle votes with its XXH64 (seed 42).  Distinct fingerprints meet in
groups that agree on two of six bit blocks: two fingerprints with at most
four differing bits always agree on two of them.  Within each group, nodes of
the binary trie over the sorted fingerprints are traversed in pairs; a pair
carries the number of bits it differs in and is dropped above the error
budget, or once all its leaves are known to be connected.

``components`` links fingerprints by these bits alone.  ``near_copies`` links
texts by the similarity of their sets of five-word shingles, 0.8 or more: such
texts often differ in ten bits and more, which no two blocks need to survive.
There the fingerprint is that of the distinct shingles, the groups are those
that share a band of minimum hashes, the trie self-join has a budget of ``NEAR_BUDGET`` bits, and an estimate of ``NEAR``
from ``SIGNATURE`` minimum hashes (its standard deviation at 0.8 is 0.035) makes
a pair a candidate.  Texts that candidates connect then meet once more with
their sets of shingles, whose exact similarity decides.

Results on unusual input: null and blank texts have fingerprint zero and
link like any other; repeated rows share their fingerprint and component; an
empty table gives an empty result; a component's id is the smallest non-null
``doc_id`` in it (null if there is none); further columns are ignored by
``components`` and ``near_copies`` and kept by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, materialize, tables

SHINGLE = 4
BUDGET = 4
#: Widths of the six blocks of a 64-bit fingerprint, from the lowest bit.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: A group of more fingerprints than this is dealt out as pairs of parts.
GROUP_LIMIT = 1 << 17
NEAR_SHINGLE = 5
NEAR_BUDGET = 22
#: Least estimate of a candidate.
NEAR = 0.65
#: Least similarity of a link: tenths.
TENTHS = 8
#: Candidates with more shingles than this are dealt out as pairs of parts.
HELD = 1 << 21
SIGNATURE = 128
#: Bands of the signature and the minimum hashes in each.
BANDS, ROWS = 14, 4
_BUFFER = 1 << 19
_FRONTIER = 1 << 18
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


_draw = np.random.default_rng(5)
_FACTORS = _draw.integers(0, 1 << 64, SIGNATURE, np.uint64, endpoint=False) | np.uint64(1)
_TERMS = _draw.integers(0, 1 << 64, SIGNATURE, np.uint64, endpoint=False)


def _shingles(text: bytes | None, shingle: int) -> np.ndarray:
    """XXH64 of each word shingle; of the whole sequence if it has fewer words; none without words."""
    words = (text or b"").translate(_LOWER).split()
    n = len(words)
    joined = b" ".join(words)
    if n <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, 42)] if n else [], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts, ends[shingle - 1 :].tolist())), np.uint64, len(starts))


def _voted(hashes: np.ndarray) -> int:
    """Each bit that is set in over half of the hashes."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one UTF-8 text."""
    return _voted(_shingles(text, shingle))


def _signature(hashes: np.ndarray) -> bytes:
    """16 bits of each of ``SIGNATURE`` minimum hashes."""
    least = np.full(SIGNATURE, np.uint64((1 << 64) - 1))
    for at in range(0, len(hashes), 1024):
        np.minimum(least, (hashes[at : at + 1024, None] * _FACTORS + _TERMS).min(axis=0), out=least)
    return (least * _FACTORS[0] >> np.uint64(48)).astype(np.uint16).tobytes()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: doc_id and fp, the fingerprint as a signed long."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([simhash(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["doc_id", "fp"])

    schema = docs.select("doc_id").schema
    return docs.select("doc_id", "text").mapInArrow(batches, schema.add("fp", "long"))


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of each a and b; afterwards ``parent`` holds each element's smallest member."""
    while True:
        x, y = parent[a], parent[b]
        if not (apart := x != y).any():
            return
        x, y = x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent[:] = up


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the similarity of two sets, sorted, is 0.8 or more."""
    if 10 * min(len(a), len(b)) < TENTHS * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 10 * both >= TENTHS * (len(a) + len(b) - both)


def trie_components(fps: np.ndarray, bounds: np.ndarray, budget: int = BUDGET, signatures: np.ndarray | None = None, sets: list[np.ndarray] | None = None) -> np.ndarray:
    """For each fingerprint the index of a representative that it is connected to.

    ``fps`` (unsigned) is sorted within each group; group i is
    ``bounds[i]:bounds[i + 1]``.  Only members of one group are compared.  With
    signatures, a link also needs a share of ``NEAR`` equal minimum hashes, and
    with sets their similarity.
    """
    n = len(fps)
    parent = np.arange(n)
    lo, hi = bounds[:-1], bounds[1:]
    lo, hi = lo[hi - lo > 1], hi[hi - lo > 1]
    stack = [(63, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    ones: dict[int, np.ndarray] = {}
    turns = np.zeros(n, np.int64)

    def changes() -> None:
        np.cumsum(parent[1:] != parent[:-1], out=turns[1:])

    def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        found = (signatures[x] == signatures[y]).mean(axis=1) >= NEAR
        if sets is not None:
            found[found] = [_similar(sets[i], sets[j]) for i, j in zip(x[found], y[found])]
        return found

    step = 4096 if sets is None else 256
    if n:
        changes()
    while stack:
        bit, alo, ahi, blo, bhi, diff = stack.pop()
        open_ = (turns[ahi - 1] != turns[alo]) | (turns[bhi - 1] != turns[blo]) | (parent[alo] != parent[blo])
        alo, ahi, blo, bhi, diff = (v[open_] for v in (alo, ahi, blo, bhi, diff))
        if bit < 0:  # all bits are spent: equal fingerprints of several texts, which are alike as a rule
            for node in zip(alo, ahi, blo, bhi):
                left, right = np.arange(*node[:2]), np.arange(*node[2:])
                for x in left:
                    y = right[parent[right] != parent[x]]
                    y = y if signatures is None else y[alike(np.full(len(y), x), y)]
                    if len(y):
                        _unite(parent, np.full(len(y), x), y)
                    if (parent[left] == parent[x]).all() and (parent[right] == parent[x]).all():
                        break
            changes()
            continue
        leaf = (ahi - alo == 1) & (bhi - blo == 1)
        if leaf.any():
            a, b = alo[leaf], blo[leaf]
            near = np.bitwise_count(fps[a] ^ fps[b]) <= budget
            a, b = a[near], b[near]
            for at in range(0, len(a), step):
                x, y = a[at : at + step], b[at : at + step]
                apart = parent[x] != parent[y]
                x, y = x[apart], y[apart]
                if signatures is not None:
                    near = alike(x, y)
                    x, y = x[near], y[near]
                if len(x):
                    _unite(parent, x, y)
            changes()
            rest = ~leaf
            alo, ahi, blo, bhi, diff = (v[rest] for v in (alo, ahi, blo, bhi, diff))
        if not len(alo):
            continue
        if len(alo) > _FRONTIER:
            half = len(alo) // 2
            stack.append((bit, alo[half:], ahi[half:], blo[half:], bhi[half:], diff[half:]))
            stack.append((bit, alo[:half], ahi[:half], blo[:half], bhi[:half], diff[:half]))
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((fps >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        one = ones[bit]
        amid, bmid = ahi - (one[ahi] - one[alo]), bhi - (one[bhi] - one[blo])
        same = alo == blo
        cross = ~same
        parts = [(alo, amid, blo, bmid, diff), (amid, ahi, bmid, bhi, diff), (alo, amid, bmid, bhi, diff + 1), (amid[cross], ahi[cross], blo[cross], bmid[cross], diff[cross] + 1)]
        made = [np.concatenate(x) for x in zip(*parts)]
        keep = (made[0] < made[1]) & (made[2] < made[3]) & (made[4] <= budget)
        keep &= ~((made[0] == made[2]) & (made[1] - made[0] == 1))
        stack.append((bit - 1, *(v[keep] for v in made)))
    return parent


def _linked(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (grp, part, key, fp), sorted by the first three: edges (u, v) that connect each group's links."""

    def edges(cols: list[np.ndarray]) -> pa.RecordBatch:
        new = np.ones(len(cols[0]), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:3]])
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        group, fps = group[many], cols[3][many].view(np.uint64)
        order = np.lexsort((fps, group))
        group, fps = group[order], fps[order]
        bounds = np.flatnonzero(np.diff(group, prepend=-1, append=-1)) if len(group) else np.zeros(1, np.int64)
        parent = trie_components(fps, bounds)
        signed, own = fps.view(np.int64), parent != np.arange(len(parent))
        return pa.RecordBatch.from_arrays([pa.array(signed[own]), pa.array(signed[parent[own]])], ["u", "v"])

    held: list[list[np.ndarray]] = []
    size = 0
    for b in it:
        held.append([b.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
        size += b.num_rows
        if size < _BUFFER:
            continue
        cols = [np.concatenate(c) for c in zip(*held)]
        last = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:3]]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield edges([c[:cut] for c in cols])
        held, size = [[c[cut:] for c in cols]], size - cut
    if size:
        yield edges([np.concatenate(c) for c in zip(*held)])


def links(distinct: DataFrame, limit: int = GROUP_LIMIT) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column fp) whose components are those of the Hamming links.

    Groups over ``limit`` are dealt out as pairs of parts, so that each task
    holds at most two parts and still every pair meets in one of them.
    """
    shift, masks = 0, []
    for width in BLOCKS:
        masks.append(((1 << width) - 1) << shift)
        shift += width
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    keys = [F.struct(F.lit(i).alias("grp"), F.col("fp").bitwiseAND(F.lit(signed(a | b)).cast("long")).alias("key")) for i, (a, b) in enumerate(combinations(masks, 2))]
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.grp", F.lit(0).alias("part"), "k.key", "fp")
    hot = materialize(keyed.groupBy("grp", "key").count().filter(F.col("count") > limit))
    if not hot.isEmpty():
        parts = F.ceil(F.col("count") / limit).cast("int")
        own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        pair = lambda j: F.least("own", j) * F.col("parts") + F.greatest("own", j)
        dealt = keyed.drop("part").join(hot.select("grp", "key", parts.alias("parts")), ["grp", "key"], "left")
        dealt = dealt.withColumn("own", F.coalesce(own, F.lit(0)))
        each = F.transform(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1), lambda j: F.coalesce(pair(j), F.lit(0)))
        keyed = dealt.select("grp", F.explode(each).alias("part"), "key", "fp")
    dealt = keyed.repartition("grp", "part", "key").sortWithinPartitions("grp", "part", "key")
    return dealt.select("grp", "part", "key", "fp").mapInArrow(_linked, "u long, v long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): for each node of an edge the smallest node it reaches, by alternating large and small stars."""
    since = tables()
    edges = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(small.filter("u <> v").distinct())
        drop_tables(since, last=1)


def components(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id for each row of ``docs`` (doc_id, text)."""
    own = materialize(fingerprints(docs))
    first = own.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = connected(links(first.select("fp")))
    placed = materialize(first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = placed.join(lowest, "root").select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", "fp", "component_id")


def described(docs: DataFrame, shingle: int = NEAR_SHINGLE) -> DataFrame:
    """doc_id, word_hash (of the normalised words), fp (of the distinct shingles), signature, shingles (sorted and distinct) and n of them for each row of ``docs``."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            words, fps, signatures, sets = [], [], [], []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                words.append(xxhash.xxh64_intdigest(b" ".join((text or b"").translate(_LOWER).split()), 42))
                h = np.unique(_shingles(text, shingle))
                fps.append(_voted(h))
                sets.append(h.tobytes())
                signatures.append(_signature(h))
            signed = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (words, fps)]
            more = [pa.array(signatures, pa.binary()), pa.array(sets, pa.binary()), pa.array([len(x) // 8 for x in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), *signed, *more], ["doc_id", "word_hash", "fp", "signature", "shingles", "n"])

    schema = docs.select("doc_id").schema.add("word_hash", "long").add("fp", "long").add("signature", "binary").add("shingles", "binary").add("n", "long")
    return docs.select("doc_id", "text").mapInArrow(batches, schema)


def _alike(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (band, key, part, node, fp, signature), sorted by the first three: edges that connect each group's links."""
    held: list[pa.RecordBatch] = []
    size = 0

    def edges(t: pa.Table) -> pa.RecordBatch:
        cols = [t.column(i).to_numpy() for i in range(5)]
        new = np.ones(len(cols[0]), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:3]])
        group = np.cumsum(new) - 1
        rows = np.flatnonzero(np.bincount(group)[group] > 1)
        group, node, fps = group[rows], cols[3][rows], cols[4][rows].view(np.uint64)
        raw = b"".join(t.column(5).take(pa.array(rows)).to_pylist())
        signatures = np.frombuffer(raw, np.uint16).reshape(len(rows), SIGNATURE)
        order = np.lexsort((fps, group))
        group, node, fps, signatures = group[order], node[order], fps[order], signatures[order]
        bounds = np.flatnonzero(np.diff(group, prepend=-1, append=-1)) if len(group) else np.zeros(1, np.int64)
        parent = trie_components(fps, bounds, NEAR_BUDGET, signatures)
        own = parent != np.arange(len(parent))
        return pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(node[parent[own]])], ["u", "v"])

    for b in it:
        held.append(b)
        size += b.num_rows
        if size < 1 << 16:
            continue
        t = pa.Table.from_batches(held)
        keys = [t.column(i).to_numpy() for i in range(3)]
        last = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in keys]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield edges(t.slice(0, cut))
        held, size = t.slice(cut).to_batches(), size - cut
    if size:
        yield edges(pa.Table.from_batches(held))


def near_links(texts: DataFrame, limit: int = GROUP_LIMIT >> 2) -> DataFrame:
    """Edges (u, v) between distinct texts (word_hash, fp, signature) that connect the candidates for a similarity of 0.8 or more."""
    band = lambda i: F.struct(F.lit(i).alias("band"), F.xxhash64(F.substring("signature", 2 * ROWS * i + 1, 2 * ROWS)).alias("key"))
    keyed = texts.select("word_hash", F.explode(F.array(*map(band, range(BANDS)))).alias("k")).select("k.band", "k.key", F.col("word_hash").alias("node"))
    shared = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1").withColumn("parts", F.ceil(F.col("n") / limit).cast("int"))
    met = materialize(keyed.join(shared.drop("n"), ["band", "key"]))
    # a group of several parts is dealt out as pairs of parts
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.least(F.col("own"), j) * F.col("parts") + F.greatest(F.col("own"), j))
    met = met.withColumn("own", own).select("band", "key", F.explode(pair).alias("part"), "node")
    full = met.join(texts.withColumnRenamed("word_hash", "node"), "node")
    dealt = full.repartition("band", "key", "part").sortWithinPartitions("band", "key", "part")
    return dealt.select("band", "key", "part", "node", "fp", "signature").mapInArrow(_alike, "u long, v long")


def _confirmed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (root, part, node, fp, signature, shingles), sorted by the first two: edges that connect each group's links."""
    held: list[pa.RecordBatch] = []
    size = 0

    def edges(t: pa.Table) -> pa.RecordBatch:
        root, part, node, fps = (t.column(i).to_numpy() for i in range(4))
        fps = fps.view(np.uint64)
        order = np.lexsort((fps, part, root))
        root, part, node, fps = root[order], part[order], node[order], fps[order]
        signatures = np.frombuffer(b"".join(t.column(4).to_pylist()), np.uint16).reshape(len(order), SIGNATURE)[order]
        raw = t.column(5).to_pylist()
        sets = [np.frombuffer(raw[i], np.uint64) for i in order.tolist()]
        bounds = np.concatenate([[0], np.flatnonzero((root[1:] != root[:-1]) | (part[1:] != part[:-1])) + 1, [len(root)]])
        parent = trie_components(fps, bounds, NEAR_BUDGET, signatures, sets)
        own = parent != np.arange(len(parent))
        return pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(node[parent[own]])], ["u", "v"])

    for b in it:
        held.append(b)
        size += b.nbytes
        if size < 1 << 24:
            continue
        t = pa.Table.from_batches(held)
        root, part = t.column(0).to_numpy(), t.column(1).to_numpy()
        last = np.flatnonzero((root[1:] != root[:-1]) | (part[1:] != part[:-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield edges(t.slice(0, cut))
        held = t.slice(cut).to_batches()
        size = sum(x.nbytes for x in held)
    if sum(b.num_rows for b in held):
        yield edges(pa.Table.from_batches(held))


def exact_links(own: DataFrame, texts: DataFrame, candidates: DataFrame, limit: int = HELD) -> DataFrame:
    """Edges (u, v) that connect the texts of similarity 0.8 or more among those that ``candidates`` (node, root) connect.

    ``own`` has row, fp, signature and shingles; ``texts`` word_hash, row and n
    of each distinct text.  Groups of more than ``limit`` shingles are dealt
    out as pairs of parts.
    """
    members = candidates.union(candidates.select("root", "root").distinct())
    members = materialize(members.join(texts.select(F.col("word_hash").alias("node"), "row", "n"), "node").select("node", "root", "row", "n"))
    parts = members.groupBy("root").agg(F.ceil(F.sum("n") / limit).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.least(F.col("mine"), j) * F.col("parts") + F.greatest(F.col("mine"), j))
    dealt = materialize(members.join(parts, "root").withColumn("mine", mine).select("root", "node", "row", pair.alias("pairs")))
    full = own.select("row", "fp", "signature", "shingles").join(dealt, "row").select("root", F.explode("pairs").alias("part"), "node", "fp", "signature", "shingles")
    full = full.repartition("root", "part").sortWithinPartitions("root", "part")
    return full.mapInArrow(_confirmed, "u long, v long")


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, word_hash and component_id for each row of ``docs``: equal and similar texts have one component."""
    own = materialize(described(docs).withColumn("row", F.monotonically_increasing_id()))
    same = [F.first(c).alias(c) for c in ("fp", "signature", "n")]
    first = materialize(own.groupBy("word_hash").agg(F.min("doc_id").alias("low"), F.min("row").alias("row"), *same))
    candidates = connected(near_links(first.select("word_hash", "fp", "signature")))
    roots = connected(exact_links(own, first, candidates)).withColumnRenamed("node", "word_hash")
    placed = materialize(first.select("word_hash", "low").join(roots, "word_hash", "left").select("word_hash", "low", F.coalesce("root", "word_hash").alias("root")))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = placed.join(lowest, "root").select("word_hash", "component_id")
    return own.select("doc_id", "word_hash").join(named, "word_hash").select("doc_id", "word_hash", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component: one document of each group stays.

    A component of rows without a doc_id keeps all of them.  Rows that repeat a kept doc_id stay with it.
    """
    found = near_copies(docs.select("doc_id", "text"))
    kept = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    return docs.filter(F.col("doc_id").isNull()).unionByName(docs.join(kept, "doc_id", "left_semi"))


def query(docs: DataFrame) -> DataFrame:
    return components(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
