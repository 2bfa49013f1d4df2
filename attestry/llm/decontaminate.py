"""Benchmark decontamination by a generalised suffix automaton of the test items' words.

Words are the runs of ASCII digits and letters (A-Z lower-cased) and of any
character beyond ASCII.  The automaton holds every word sequence that occurs in
an item.  Each document's words stream through it with the length of the
longest match that ends there; where it reaches a window's length, the
window's words are hit.  A window is any ``window`` consecutive words of an
item, or a whole shorter item.

The items are read one part after the other: at most ``PART`` words, long ones
counted as several.  (A longer item is cut into parts that share a window's
words less one, so that every window is whole in one of them.)  A part is all
that the driver, a broadcast or a task's automaton holds.  Items of one part, as
a usual set of test items is, take one pass over the documents; of more parts,
each takes a pass, and the hits are merged by document.

Results on unusual input: null texts and items have no words and match
nothing; repeated rows and items count alike; items without id count as the
empty id; empty tables give no hits or no rows; further columns are ignored by
``scan`` and kept by ``drop_contaminated`` and ``cut_spans``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from .common import materialize

WINDOW = 13
#: A document is contaminated if hit words are at least this share of its words: 1 in so many.
SHARE = 20
#: Item words in one automaton; eight bytes of a word count as one more.
PART = 400_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOLD = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class Automaton:
    """All word sequences of the items, with the windows that end in each state."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.short: dict[int, dict[int, set[str]]] = {}
        self.long: dict[int, set[str]] = {}
        texts = [(i, words_of(t)) for i, t in items]
        for _, words in texts:
            last = 0
            for w in words:
                last = self._extend(last, w)
        for item, words in texts:
            state = 0
            for w in words:
                state = self.next[state][w]
                up = state
                while up > 0 and self.length[up] >= window and item not in self.long.setdefault(up, set()):
                    self.long[up].add(item)
                    up = self.link[up]
            if words and len(words) < window:
                while self.length[self.link[state]] >= len(words):
                    state = self.link[state]
                self.short.setdefault(state, {}).setdefault(len(words), set()).add(item)
        #: From this match length on, some window ends in the state.
        self.need = [1 << 60] * len(self.next)
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            least = min(self.short.get(v, {}), default=1 << 60)
            if self.length[v] >= window:
                least = min(least, window)
            if self.need[self.link[v]] < 1 << 60:
                least = 0
            self.need[v] = least

    def _new(self, length: int, link: int, follow: dict[bytes, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """A copy of q for the shorter sequences, those that end in p and w."""
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _windows(self, v: int, matched: int) -> tuple[int, set[str]]:
        """The longest window that ends at a match of this length in state v, and the items of all such windows."""
        most, found = 0, set()
        if matched >= self.window:
            most, up = self.window, v
            while self.length[self.link[up]] >= self.window:
                up = self.link[up]
            found |= self.long[up]
        while v > 0:
            for n, items in self.short.get(v, {}).items():
                if n <= matched:
                    most = max(most, n)
                    found |= items
            v = self.link[v]
        return most, found

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint spans of hit words, in order, and the items whose windows occur."""
        follow, link, length, need = self.next, self.link, self.length, self.need
        root = follow[0]
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        v = matched = 0
        for i, w in enumerate(words):
            if w in follow[v]:
                v = follow[v][w]
                matched += 1
            elif w in root:
                while w not in follow[v]:
                    v = link[v]
                matched = length[v] + 1
                v = follow[v][w]
            else:
                v = matched = 0
                continue
            if matched >= need[v]:
                n, found = self._windows(v, matched)
                items |= found
                start = i + 1 - n
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, items


def _parts(items: DataFrame, limit: int, window: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items' distinct ids and texts, in lists of at most ``limit`` words, one list at a time."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.coalesce("text", F.lit("")).cast("binary").alias("t")).distinct()
    part: list[tuple[str, bytes]] = []
    size = 0
    for r in rows.sort("i", "t").toLocalIterator():
        words = words_of(bytes(r.t))
        start = 0
        while start < len(words):
            n, end = 0, start
            while end < len(words) and (end - start < window or n < limit):
                n += 1 + len(words[end]) // 8
                end += 1
            if size and size + n > limit:
                yield part
                part, size = [], 0
            part.append((r.i, b" ".join(words[start:end])))
            size += n
            # the next piece begins with the last words of this one, unless no window is left
            start = end - window + 1 if end < len(words) else end
    if part:
        yield part


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            s, e = out[-1][0], max(e, out.pop()[1])
        out.append((s, e))
    return out


def _annotated_once(docs: DataFrame, part: list[tuple[str, bytes]], window: int) -> DataFrame:
    """``docs`` with ``_FOUND``: its words, the spans of hit words and the sorted ids of the items they come from."""
    shared = docs.sparkSession.sparkContext.broadcast(part)
    at = docs.columns.index("text")
    schema = StructType([*docs.schema.fields]).add(_N, LongType()).add(_SPANS, ArrayType(ArrayType(LongType()))).add(_ITEMS, ArrayType(StringType()))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(shared.value, window)
        for b in it:
            n_words, spans, found = [], [], []
            for t in b.column(at).cast(pa.binary()).to_pylist():
                words = words_of(t)
                hit, items = automaton.scan(words)
                n_words.append(len(words))
                spans.append([list(x) for x in _merged(hit)])
                found.append(sorted(items))
            more = [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, *_FOUND])

    return docs.mapInArrow(batches, schema)


_N, _SPANS, _ITEMS = _FOUND = ("__n_words", "__hit_spans", "__hit_items")


def annotated(docs: DataFrame, items: DataFrame, window: int = WINDOW, limit: int = PART) -> DataFrame:
    """``docs`` with __n_words, __hit_spans (word positions, ends exclusive) and __hit_items (sorted ids)."""
    parts = _parts(items, limit, window)
    first, second = next(parts, []), next(parts, None)
    if second is None:
        return _annotated_once(docs, first, window)
    rows = materialize(docs.withColumn("__row", F.monotonically_increasing_id()))
    counted = materialize(_annotated_once(rows, first, window))
    passes = [counted.select("__row", _SPANS, _ITEMS)]
    while second is not None:
        passes.append(materialize(_annotated_once(rows.select("__row", "text"), second, window).filter(F.size(_SPANS) > 0).select("__row", _SPANS, _ITEMS)))
        second = next(parts, None)
    every = passes[0].filter(F.size(_SPANS) > 0)
    for more in passes[1:]:
        every = every.unionByName(more)
    both = every.groupBy("__row").agg(F.flatten(F.collect_list(_SPANS)).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(_ITEMS)))).alias("i"))
    # spans in order, each joined to the last one where they touch
    joined = """aggregate(slice(array_sort(s), 2, size(s)), array(array_sort(s)[0]), (a, x) -> if(x[0] <= element_at(a, -1)[1],
      concat(slice(a, 1, size(a) - 1), array(array(element_at(a, -1)[0], greatest(element_at(a, -1)[1], x[1])))), array_append(a, x)))"""
    both = both.select("__row", F.expr(joined).alias("s"), "i")
    out = counted.drop(_SPANS, _ITEMS).join(both, "__row", "left")
    none = lambda c, t: F.coalesce(c, F.array().cast(t))
    return out.select(*docs.columns, _N, none("s", "array<array<bigint>>").alias(_SPANS), none("i", "array<string>").alias(_ITEMS))


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, limit: int = PART) -> DataFrame:
    """doc_id, n_words, spans (word positions, ends exclusive) and items (sorted ids) for each row of ``docs``."""
    found = annotated(docs.select("doc_id", "text"), items, window, limit)
    return found.select("doc_id", F.col(_N).alias("n_words"), F.col(_SPANS).alias("spans"), F.col(_ITEMS).alias("items"))


def _n_hit(spans: str):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])


def _judged(spans: str, n_words: str, share: int):
    return (_n_hit(spans) > 0) & (share * _n_hit(spans) >= F.col(n_words))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = SHARE, limit: int = PART) -> DataFrame:
    """The rows of ``docs`` without those whose hit words reach the coverage limit; the rest is unchanged."""
    return annotated(docs, items, window, limit).filter(~_judged(_SPANS, _N, share)).drop(*_FOUND)


def cut_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = SHARE, limit: int = PART) -> DataFrame:
    """``docs`` with the hit words cut out of each text that reaches the coverage limit."""
    found = annotated(docs, items, window, limit).withColumn("__cut", _judged(_SPANS, _N, share))
    at, kept = docs.columns.index("text"), len(docs.columns)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = b.column(at).cast(pa.binary()).to_pylist()
            for k, (spans, bad) in enumerate(zip(b.column(kept + 1).to_pylist(), b.column(kept + 3).to_pylist())):
                if bad:
                    raw = texts[k]
                    places = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
                    edges = [0, *(x for s, e in spans for x in (places[s][0], places[e - 1][1])), len(raw)]
                    texts[k] = b"".join(raw[i:j] for i, j in zip(edges[::2], edges[1::2]))
            columns = list(b.columns)[:kept]
            columns[at] = pa.array(texts, pa.binary()).cast(b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names[:kept])

    return found.mapInArrow(batches, docs.schema)


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = scan(docs, items)
    sha = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", _n_hit("spans").alias("n_hit"), F.size("items").cast("long").alias("n_items"), sha.alias("items_sha256"), _judged("spans", "n_words", SHARE).alias("contaminated"))


_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

#: Every window of every item against every sequence of as many words of every document.
ORACLE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, {_SQL_WORDS} AS ws FROM documents
), items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, {_SQL_WORDS} AS ws FROM benchmark
), windows AS (
  SELECT DISTINCT item, n, array_to_string(ws[i + 1 : i + n], ' ') AS win FROM (SELECT item, ws, least({WINDOW}, len(ws)) AS n, unnest(range(len(ws) - least({WINDOW}, len(ws)) + 1)) AS i FROM items WHERE len(ws) > 0)
), places AS (
  SELECT row, n, i, array_to_string(ws[i + 1 : i + n], ' ') AS win FROM (SELECT row, ws, n, unnest(range(len(ws) - n + 1)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n)
), met AS (
  SELECT row, item, p.n, i FROM places p JOIN windows w ON p.n = w.n AND p.win = w.win
), hit AS (
  SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS k FROM met) GROUP BY row
), named AS (
  SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM met GROUP BY row
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {SHARE} * n_hit >= len(ws) AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""
