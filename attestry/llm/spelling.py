"""Spelling variants: near words by a forward and a backward minimal acyclic automaton.

Words are counted over all documents.  Two words are near if they differ by exactly
one inserted, deleted or replaced character.  Wherever the difference lies, one
half of a word is free of it.  So each word is looked up twice: its first half is
followed exactly through the automaton of all words, and what is left completed
with one error; and its last half through the automaton of all words spelled
backwards.  Each automaton is minimal and numbers its words by a perfect hash (the
words accepted on the way before one), so that what is found is a number, and counts
stand in an array by it.  A near word whose first half is the same is found forwards;
backwards it is skipped, so that no pair counts twice.

The words in order, and the reversed words in order, are cut into ranges of about
``HELD`` words, at bounds taken from a share of them by hash, the same in every run and some
``SAMPLED`` words at most.  Each range is one automaton in one task.  A word is looked up where the words lie that
begin with its half: in one range, or in several if the half is that common.  Where
more words look up than a range holds, they are dealt over tasks, each with the automaton.

A word's form is its near word of the largest count, if that is ``TIMES`` times its
own at least.  Forms are followed to the last by pointer jumping: counts grow by
``TIMES`` with each step, so that a few rounds of joins do.

Results on unusual input: null texts have no words, a null doc_id counts as the
empty text; rows that repeat count as often as they occur; ties between forms go
to the smallest word in code-point order; words of any length take part; an empty
table, or one in which no word is frequent enough, gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_sql, materialize

MIN_LENGTH = 6
MIN_TIMES = 5
#: How many times as frequent as a word its form must be.
TIMES = 5
#: One of so many runs of letters, by its hash, loses a character.
SLIP = 199
#: Words of one automaton.
HELD = 20_000
#: Words that a task counts before it passes them on.
COUNTED = 1 << 18
#: Words from which the bounds between ranges are taken at most, about.
SAMPLED = 100_000
#: Characters of a bound between two ranges.
BOUND = 256


def slipped(doc_id: object, runs: Counter) -> Iterator[tuple[str, int]]:
    """The words of a document's lower-cased runs, some of them short of one character, and how often each occurs."""
    before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, times in runs.items():
        h = zlib.crc32(run.encode(), before)
        if h % SLIP == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, times


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_times: int = MIN_TIMES) -> DataFrame:
    """word and n: the words of ``docs`` (doc_id, text) of ``min_length`` characters or more that occur ``min_times`` times."""
    letters = re.compile(f"[a-zÀ-ÿ]{{{min_length},}}")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "times"])
            held.clear()
            return out

        for b in it:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                # of bytes, only A-Z are lower-cased
                low = (text or "").encode("utf-8", "replace").lower().decode()
                for word, times in slipped(doc_id, Counter(letters.findall(low))):
                    if len(word) >= min_length:
                        held[word] += times
                if len(held) > COUNTED:
                    yield flush()
        yield flush()

    found = docs.select("doc_id", "text").mapInArrow(batches, "word string, times long")
    return found.groupBy("word").agg(F.sum("times").alias("n")).filter(F.col("n") >= min_times)


class Automaton:
    """The minimal acyclic automaton of words in order, each numbered by its place."""

    def __init__(self, ordered: list[str]):
        self.known: dict[tuple, int] = {}
        #: by state: next states by character, the number of words on the way before each, and whether a word ends here
        self.next: list[dict[str, int]] = []
        self.skipped: list[dict[str, int]] = []
        self.ends: list[bool] = []
        self.count: list[int] = []
        last, path = "", [[False, {}]]  # what is not yet shared: the states of the last word
        for word in ordered:
            same = 0
            while same < len(last) and same < len(word) and last[same] == word[same]:
                same += 1
            self._share(path, last, same)
            for c in word[same:]:
                path.append([False, {}])
            path[-1][0] = True
            last = word
        self._share(path, last, 0)
        self.root = self._state(*path[0])

    def _share(self, path: list, word: str, length: int) -> None:
        """Replaces the states beyond ``length`` characters by shared ones."""
        while len(path) > length + 1:
            end, follow = path.pop()
            path[-1][1][word[len(path) - 1]] = self._state(end, follow)

    def _state(self, end: bool, follow: dict[str, int]) -> int:
        key = (end, tuple(follow.items()))
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.next)
            before, skipped = int(end), {}
            for c, state in follow.items():  # in order, as the words are
                skipped[c] = before
                before += self.count[state]
            self.next.append(follow)
            self.skipped.append(skipped)
            self.ends.append(end)
            self.count.append(before)
        return found

    def _exact(self, state: int, number: int, rest: str) -> int:
        """The number of the word that ends ``rest`` from here, or -1."""
        follow, skipped = self.next, self.skipped
        for c in rest:
            to = follow[state].get(c)
            if to is None:
                return -1
            number += skipped[state][c]
            state = to
        return number if self.ends[state] else -1

    def near(self, word: str, half: int) -> set[int]:
        """Numbers of the words that begin with the first ``half`` characters and differ from ``word`` by one error behind them."""
        state, number = self.root, 0
        for c in word[:half]:
            to = self.next[state].get(c)
            if to is None:
                return set()
            number += self.skipped[state][c]
            state = to
        found = set()
        for at in range(half, len(word) + 1):
            rest = word[at + 1 :]
            own = word[at] if at < len(word) else None
            if own is not None:
                found.add(self._exact(state, number, rest))  # deleted
            for c, to in self.next[state].items():
                here = number + self.skipped[state][c]
                found.add(self._exact(to, here, word[at:]))  # inserted
                if own is not None and c != own:
                    found.add(self._exact(to, here, rest))  # replaced
            if own is None or own not in self.next[state]:
                break
            number += self.skipped[state][own]
            state = self.next[state][own]
        found.discard(-1)
        return found


def _bounds(table: DataFrame, held: int) -> tuple[list[str], list[str]]:
    """Where the words in order, and the reversed words in order, are cut into ranges of about ``held``."""
    n = table.count()
    ranges = -(-n // held)
    if ranges < 2:
        return [], []
    share = max(1, held // 64, n // SAMPLED)  # some 64 words of each range are looked at, and about SAMPLED in all at most
    found = [r.word for r in table.filter(F.pmod(F.xxhash64("word"), F.lit(share)) == 0).select(F.substring("word", 1, BOUND).alias("word")).collect()]
    ends = [r.word for r in table.filter(F.pmod(F.xxhash64("word"), F.lit(share)) == 0).select(F.substring(F.reverse("word"), 1, BOUND).alias("word")).collect()]
    cut = lambda xs: sorted({xs[len(xs) * k // ranges] for k in range(1, ranges)}) if xs else []
    return cut(sorted(found)), cut(sorted(ends))


def _routed(table: DataFrame, bounds: tuple[list[str], list[str]], slices: dict[tuple[int, int], int]) -> DataFrame:
    """direction (0 forward, 1 backward), range, slice, spelling (in that direction), half (null for a range's own words) and n.

    A word is in one range of each direction, in all of its slices, and is looked up in a slice of each range where words begin with its half.
    """
    shared = table.sparkSession.sparkContext.broadcast((bounds, slices))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, dealt = shared.value
        for b in it:
            rows = []
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for direction, spelling, half in ((0, word, len(word) // 2), (1, word[::-1], len(word) - len(word) // 2)):
                    own = bisect_right(cuts[direction], spelling)
                    rows += [(direction, own, k, spelling, None, n) for k in range(dealt.get((direction, own), 1))]
                    begin = spelling[:half]
                    first, last = bisect_right(cuts[direction], begin), bisect_left(cuts[direction], begin + "\U0010ffff")
                    for at in range(first, last + 1):
                        rows.append((direction, at, zlib.crc32(word.encode()) % dealt.get((direction, at), 1), spelling, half, n))
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64())
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["direction", "range", "slice", "spelling", "half", "n"])

    return table.select("word", "n").mapInArrow(batches, "direction int, range int, slice int, spelling string, half int, n long")


def _looked_up(group: pd.DataFrame) -> pd.DataFrame:
    """word, near and near_n of one range and slice."""
    own = group[group["half"].isna()].sort_values("spelling")
    spelled, counts = own["spelling"].tolist(), own["n"].tolist()
    automaton, backward = Automaton(spelled), bool(group["direction"].iat[0])
    rows = []
    asking = group[group["half"].notna()]
    for word, half in zip(asking["spelling"].tolist(), asking["half"].astype(int).tolist()):
        for number in automaton.near(word, half):
            other = spelled[number]
            if other == word:
                continue
            if backward:
                one, two = word[::-1], other[::-1]
                if one[: len(one) // 2] != two[: len(one) // 2]:
                    rows.append((one, two, counts[number]))
            else:
                rows.append((word, other, counts[number]))
    return pd.DataFrame(rows, columns=["word", "near", "near_n"])


def near_words(table: DataFrame, held: int = HELD) -> DataFrame:
    """word, near and near_n: all ordered pairs of words of ``table`` (word, n) that differ by one character."""
    bounds = _bounds(table, held)
    asked = _routed(table, bounds, {}).filter("half is not null").groupBy("direction", "range").count().filter(F.col("count") > 2 * held)
    slices = {(r["direction"], r["range"]): -(-r["count"] // (2 * held)) for r in asked.collect()}  # a number for each range at most
    routed = _routed(table, bounds, slices)
    return routed.groupBy("direction", "range", "slice").applyInPandas(_looked_up, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of each row of ``forms`` (word, form): the end of the chain, by jumps of doubled length."""
    now = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = now.join(on, "root", "left")
        if stepped.filter("further is not null").isEmpty():
            return now
        now = materialize(stepped.select("word", F.coalesce("further", "root").alias("root")))


def variants(docs: DataFrame, times: int = TIMES, min_length: int = MIN_LENGTH, min_times: int = MIN_TIMES, held: int = HELD) -> DataFrame:
    """word, form, root, n, n_near and form_n for each word of ``docs`` (doc_id, text)."""
    table = materialize(words(docs, min_length, min_times))
    # the largest count, then the smallest word
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    found = near_words(table, held).groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = table.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    is_form = F.col("near_n") >= times * F.col("n")
    joined = materialize(joined.select("word", "n", "n_near", F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")))
    roots = _roots(joined.filter("form is not null"))
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


query = variants

#: Near words by the words short of one character at each place, by joins.
ORACLE = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents
), counted AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS word, run, count(*) AS n FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL
), {crc_sql("SELECT word FROM counted")}, slipped AS (
  SELECT CASE WHEN crc % {SLIP} = 0 THEN left(run, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n FROM counted JOIN crcs USING (word)
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_TIMES}
), short AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS s FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM short a JOIN short b ON a.s = b.s AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM short a JOIN words b ON b.word = a.s
  UNION SELECT b.word, a.word, a.n FROM short a JOIN words b ON b.word = a.s
), best AS (
  SELECT word, near, near_n, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
), forms AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {TIMES} * n THEN near END AS form, CASE WHEN near_n >= {TIMES} * n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND k = 1
), chain(word, at_word) AS (
  SELECT word, word FROM words UNION ALL SELECT c.word, form FROM chain c JOIN forms f ON f.word = c.at_word WHERE form IS NOT NULL
)
SELECT f.word, f.form, at_word AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c USING (word) JOIN forms e ON e.word = c.at_word WHERE e.form IS NULL
"""
