"""License scans with a positional index of rare words, with DataFrame functions only.

Each template is a sequence of words with mandatory key phrases; its stop words
only hold places.  A first pass counts, over all documents, in how many each
template word stands.  The index is made once: the rarest word of each template's key
phrases is posted with the template and its place there.  (A file that has the
phrases has all their words, so that of those which it has the one of the highest
inverse document frequency is always posted, and no template is lost; common
words, as most files have, are never looked up.)

The second pass handles each file by itself.  Where one of its words is posted, its
place less the posted one is a candidate: a template and where it would start.  So
the work on a file grows with its rare licence words, and not with the number of
templates.  Each candidate's other postings are intersected with the file's words by
relative place, where up to ``SLACK`` words may have come in or gone out.  A label
is given if enough of them agree and each key phrase, stop words included, stands
word by word at its place, give or take the same slack.  The score is the share of
the template's inverse document frequencies that agree, so that 1 is a whole template.

The base phrases are found beside this: places where their words stand one
after the other.

Results on unusual input: null and empty texts have no words and no labels; a
document without base phrase has null first and last words; among several starts
of a template the best score counts, and of words of equal frequency the smaller
one is posted; repeated rows get equal results; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base phrases with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Sentences, beginnings and whole texts of well-known licences, by label; key phrases stand in brackets.
TEMPLATES = {
    "agpl": "gnu [affero general public license]",
    "apache": "licensed under the [apache license] version 2 0",
    "apache-2": "licensed under the [apache 2 0 license]",
    "apache-notice": "licensed under the [apache license version 2 0] the license [you may not use this file except in compliance] with the license you may obtain a copy of the license at "
    "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
    "without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "apache-terms": "you may not use this file [except in compliance with the license]",
    "artistic": "licensed under the [artistic license] 2 0",
    "boost": "distributed under the [boost software license] version 1 0",
    "bsd": "[redistribution and use in source] and [binary forms] with or without modification are permitted",
    "bsd-endorse": "[may be used to endorse or promote products] derived from this software without specific prior written permission",
    "bsd-text": "[redistribution and use in source] and [binary forms] with or without modification are permitted provided that the following conditions are met "
    "redistributions of source code must [retain the above copyright notice] this list of conditions and the following disclaimer "
    "redistributions in binary form must [reproduce the above copyright notice] this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability "
    "and fitness for a particular purpose are disclaimed",
    "cc": "licensed under a [creative commons] attribution license",
    "cc-by-nc": "licensed under [cc by nc] 4 0",
    "cc-by-nd": "licensed under [cc by nd] 4 0",
    "cc-by-sa": "licensed under [cc by sa] 4 0",
    "cc0": "[cc0 1 0 universal] public domain dedication",
    "cddl": "subject to the terms of the [common development and distribution license]",
    "epl": "[eclipse public license] version 2 0",
    "gfdl": "under the terms of the [gnu free documentation license]",
    "gpl": "licensed under the [gnu general public license] version 3",
    "gpl-notice": "this program is free software [you can redistribute it and or modify it] under the terms of the gnu general public license as published by the free software foundation",
    "gpl-text": "this program is free software [you can redistribute it and or modify it] under the terms of the [gnu general public license] as published by the free software foundation "
    "either version of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty "
    "of merchantability or fitness for a particular purpose see the gnu general public license for more details you should have received a copy of the gnu general public license along with this program",
    "isc": "released under the [isc license]",
    "isc-terms": "[permission to use copy modify and or distribute this software] for any purpose with or without fee is hereby granted",
    "isc-text": "[permission to use copy modify] and or [distribute this software] for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice "
    "appear in all copies the software is provided as is and the [author disclaims all warranties] with regard to this software including all implied warranties of merchantability and fitness "
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits",
    "lgpl": "gnu [lesser general public license] version",
    "mit": "released under the [mit license]",
    "mit-notice": "[the above copyright notice and this permission notice] shall be included in all copies or substantial portions of the software",
    "mit-terms": "[permission is hereby granted free of charge] to any person obtaining a copy",
    "mit-text": "[permission is hereby granted free of charge] to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
    "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
    "subject to the following conditions [the above copyright notice and this permission notice] shall be included in all copies or substantial portions of the software "
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection "
    "with the software or the use or other dealings in the software",
    "mpl": "subject to the terms of the [mozilla public license]",
    "ofl": "licensed under the [sil open font license] version 1 1",
    "public-domain": "released into the [public domain]",
    "unlicense": "[free and unencumbered software] released into the public domain",
    "unlicense-text": "this is [free and unencumbered software] released into the [public domain] anyone is free to copy modify publish use compile sell or distribute this software "
    "either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "warranty": "provided as is [without warranty of any kind] express or implied",
    "zlib": "this software is provided [as is without any express or implied warranty] in no event will the authors be held liable",
    "zlib-text": "this software is provided [as is without any express or implied warranty] in no event will the authors be held liable for any damages arising from the use of this software "
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions "
    "the origin of this software [must not be misrepresented] you must not claim that you wrote the original software",
}

STOP = frozenset("a all and any are as at be by for from in into is it no not of on or that the this to under with you use may".split())
#: Share of a template's posted words that must stand in their places.
QUORUM = 0.4
#: Words by which a place may be off.
SLACK = 3
#: Buckets of the index, by the hash of a word.
BUCKETS = 64


@dataclass(frozen=True)
class Post:
    """A template's word and its place; which key phrase it is in (from 1, 0 for none), and whether it is posted (no stop word)."""

    label: str
    word: str
    at: int
    phrase: int

    @property
    def posted(self) -> bool:
        return self.word not in STOP


def postings(templates: Mapping[str, str] = TEMPLATES) -> list[Post]:
    """All words of all templates in order."""
    rows = []
    for label, text in templates.items():
        phrase, inside = 0, False
        for at, token in enumerate(text.split()):
            if token.startswith("["):
                phrase, inside = phrase + 1, True
            rows.append(Post(label, token.strip("[]"), at, phrase if inside else 0))
            inside = inside and not token.endswith("]")
    return rows


def index_words(templates: Mapping[str, str] = TEMPLATES) -> list[str]:
    return sorted({p.word for p in postings(templates) if p.posted})


def _words(text: Column) -> Column:
    """The text's words (lower-cased), with one space before and after each."""
    # two characters beyond ASCII have ASCII lower-case forms; as any other letters they are kept out of phrases
    for c in "\u212a\u0130":
        text = F.replace(text, F.lit(c), F.lit("\u00e5"))
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")), F.lit(" "))


def frequencies(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> tuple[int, dict[str, int]]:
    """The number of documents, and in how many of them each index word stands: a row for each index word at most."""
    known = index_words(templates)
    words = ", ".join(f"'{w}'" for w in ["-", *known])  # no text has the word of a sign, which keeps the list from being empty
    norm = docs.select(_words(F.coalesce("text", F.lit(""))).alias("w"))
    # the empty word counts the documents
    seen = norm.select(F.explode(F.expr(f"concat(array(''), array_distinct(filter(split(w, ' '), x -> x in ({words}))))")).alias("word"))
    found = {r.word: r.n for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return found.get("", 0), {w: found.get(w, 0) for w in known}


def looked_up(found: Mapping[str, int], templates: Mapping[str, str] = TEMPLATES) -> dict[str, str]:
    """Of each template, the rarest word of its key phrases."""
    keys: dict[str, set[str]] = {}
    for p in postings(templates):
        if p.phrase and p.posted:
            keys.setdefault(p.label, set()).add(p.word)
    return {label: min(words, key=lambda w: (found.get(w, 0), w)) for label, words in keys.items()}


def _array(rows: Iterable[str], kind: str) -> str:
    rows = list(rows)
    return f"array({', '.join(rows)})" if rows else f"cast(array() as array<{kind}>)"


def index(found: Mapping[str, int], templates: Mapping[str, str] = TEMPLATES) -> list[tuple[str, int, int]]:
    """word, number of the template and place of each posting that is looked up."""
    picked, number = looked_up(found, templates), {label: k for k, label in enumerate(templates)}
    return [(p.word, number[p.label], p.at) for p in postings(templates) if p.phrase and p.word == picked.get(p.label)]


def proposed(ws: str, posts: list[tuple[str, int, int]]) -> str:
    """SQL of the candidates of the words in array ``ws``, as structs of t (a template's number) and s (its start), each once."""
    buckets: list[list[str]] = [[] for _ in range(BUCKETS)]
    kind = "struct<word:string,t:int,at:int>"
    for word, t, at in posts:
        buckets[_bucket(word)].append(f"named_struct('word', '{word}', 't', {t}, 'at', {at})")
    if not posts:
        return "cast(array() as array<struct<t:int,s:int>>)"
    known = ", ".join(f"'{w}'" for w in sorted({w for w, _, _ in posts}))
    places = f"filter(transform({ws}, (x, j) -> if(x in ({known}), j, -1)), j -> j >= 0)"
    own = f"filter(get({_array((_array(b, kind) for b in buckets), f'array<{kind}>')}, cast(pmod(crc32({ws}[j]), {BUCKETS}) as int)), e -> e.word = {ws}[j])"
    return f"array_distinct(flatten(transform({places}, j -> transform({own}, e -> named_struct('t', e.t, 's', j - e.at)))))"


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def matches(w: str, n: int, found: Mapping[str, int], templates: Mapping[str, str] = TEMPLATES) -> Column:
    """label and score of each template that stands in the normalised text of column ``w``; a template may come more than once."""
    idf = lambda word: f"ln(({n} + 1) / ({found.get(word, 0)} + 0.5D))"
    rows = []
    for label in templates:
        own = [p for p in postings(templates) if p.label == label]
        posts = [f"named_struct('word', '{p.word}', 'at', {p.at}, 'idf', {idf(p.word)})" for p in own if p.posted]
        phrases = []
        for k in range(1, max((p.phrase for p in own), default=0) + 1):
            inside = [p for p in own if p.phrase == k]
            phrases.append(f"named_struct('at', {inside[0].at}, 'words', array({', '.join(repr(p.word) for p in inside)}))")
        rows.append(f"named_struct('label', '{label}', 'need', {QUORUM}D * {len(posts)}, 'posts', {_array(posts, 'struct<word:string,at:int,idf:double>')}, 'phrases', {_array(phrases, 'struct<at:int,words:array<string>>')})")

    # let(x, v, e): e with x for the value v, computed once
    let = lambda name, value, body: f"transform(array({value}), {name} -> {body})[0]"
    shifts = f"sequence(-{SLACK}, {SLACK})"
    agree = f"filter(t.posts, y -> exists({shifts}, k -> get(ws, c.s + y.at + k) = y.word))"
    verified = f"forall(t.phrases, p -> exists({shifts}, k -> c.s + p.at + k >= 0 and slice(ws, greatest(1, c.s + p.at + k + 1), size(p.words)) = p.words))"
    score = "aggregate(m, 0D, (a, y) -> a + y.idf) / aggregate(t.posts, 0D, (a, y) -> a + y.idf)"
    judged = let("t", f"get({_array(rows, 'string')}, c.t)", f"if({verified}, {let('m', agree, f'named_struct({chr(39)}label{chr(39)}, t.label, {chr(39)}score{chr(39)}, if(size(m) >= t.need, {score}, 0D))')}, named_struct('label', t.label, 'score', 0D))")
    if not rows:
        return F.expr("cast(array() as array<struct<label:string,score:double>>)")
    return F.expr(let("ws", f"split(btrim({w}), ' ')", f"filter(transform({proposed('ws', index(found, templates))}, c -> {judged}), x -> x.score > 0)"))


def candidates(docs: DataFrame, n: int, found: Mapping[str, int], templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, label and start of all that the index proposes."""
    norm = docs.select("doc_id", F.split(F.btrim(_words(F.coalesce("text", F.lit("")))), " ").alias("ws"))
    labels = F.array(*map(F.lit, templates))
    each = norm.select("doc_id", F.explode(F.expr(proposed("ws", index(found, templates)))).alias("c"))
    return each.select("doc_id", F.get(labels, "c.t").alias("label"), F.col("c.s").alias("start"))


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels (sorted, base ones included) and score for each row of ``docs``.

    The score is 1 with a base label, else that of the best template.
    """
    n, found = frequencies(docs, templates)
    norm = docs.select("doc_id", _words(F.coalesce("text", F.lit(""))).alias("w"))
    phrase = "|".join(BASE)
    has = {label: F.col("w").contains(f" {p} ") for p, label in BASE.items()}
    any_base = F.lit(False)
    for c in has.values():
        any_base |= c
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    before_first = F.regexp_extract("w", rf"(?s)\A(.*?) (?:{phrase}) ", 1)
    before_last = F.regexp_extract("w", rf"(?s)\A(.*) (?:{phrase}) ", 1)
    out = norm.select(
        "doc_id",
        F.when(F.col("w") == "  ", 0).otherwise(spaces(F.col("w")) - 1).cast("long").alias("n_words"),
        F.when(any_base, F.regexp_count("w", F.lit(rf" (?:{phrase})(?= )"))).otherwise(0).cast("long").alias("n_base"),
        F.when(any_base, spaces(before_first)).cast("long").alias("first_word"),
        F.when(any_base, spaces(before_last)).cast("long").alias("last_word"),
        F.array_compact(F.array(*(F.when(has[label], F.lit(label)) for label in sorted(has)))).alias("base_labels"),
        matches("w", n, found, templates).alias("found"),
    )
    labels = F.array_sort(F.array_union("base_labels", F.transform("found", lambda m: m["label"])))
    score = F.when(F.size("base_labels") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("found", lambda m: m["score"])), F.lit(0.0)))
    return out.withColumn("labels", labels).withColumn("score", score).drop("found")


def query(docs: DataFrame) -> DataFrame:
    found = scan(docs)
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), F.round("score", 6).alias("score"))


_POSTED = ", ".join(f"('{p.label}', '{p.word}', {p.at}, {p.posted}, {p.phrase})" for p in postings())

#: Every start that a template's rarest key word gives, by joins.
ORACLE = f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS place FROM texts
), base AS (
  SELECT doc_id, i AS place, CASE WHEN ws[i + 1] = 'cc' AND ws[i + 2] = 'by' THEN 'cc-by' WHEN ws[i + 1] = 'general' AND ws[i + 2] = 'public' AND ws[i + 3] = 'license' THEN 'gpl'
    WHEN ws[i + 1] = 'all' AND ws[i + 2] = 'rights' AND ws[i + 3] = 'reserved' THEN 'reserved' END AS label
  FROM (SELECT doc_id, ws, unnest(range(len(ws))) AS i FROM texts)
), based AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base WHERE label IS NOT NULL GROUP BY doc_id
), posts(label, word, spot, posted, phrase) AS (VALUES {_POSTED}), rare AS (
  SELECT w.word, coalesce(f.n, 0) AS n, ln(((SELECT count(*) FROM documents) + 1) / (coalesce(f.n, 0) + 0.5)) AS idf
  FROM (SELECT DISTINCT word FROM posts WHERE posted) w LEFT JOIN (SELECT word, count(DISTINCT doc_id) AS n FROM words GROUP BY word) f USING (word)
), picked AS (
  SELECT label, arg_min(word, struct_pack(a := n, b := word)) AS word FROM posts JOIN rare USING (word) WHERE phrase > 0 AND posted GROUP BY label
), starts AS (
  SELECT DISTINCT doc_id, label, place - spot AS start FROM picked JOIN posts USING (label, word) JOIN words USING (word) WHERE phrase > 0
), near AS (
  SELECT s.doc_id, s.label, s.start, p.spot, p.posted, p.phrase, p.word, w.place - s.start - p.spot AS k
  FROM starts s JOIN posts p USING (label) JOIN words w ON w.doc_id = s.doc_id AND w.word = p.word AND w.place BETWEEN s.start + p.spot - {SLACK} AND s.start + p.spot + {SLACK}
), agreed AS (
  SELECT doc_id, label, start, count(*) AS n, sum(idf) AS idf FROM (SELECT DISTINCT doc_id, label, start, spot, word FROM near WHERE posted) JOIN rare USING (word) GROUP BY ALL
), sizes AS (
  SELECT label, phrase, count(*) AS size FROM posts WHERE phrase > 0 GROUP BY ALL
), stood AS (
  SELECT DISTINCT doc_id, label, start, phrase FROM (SELECT doc_id, label, start, phrase, k, count(*) AS c FROM near WHERE phrase > 0 GROUP BY ALL) JOIN sizes USING (label, phrase) WHERE c = size
), verified AS (
  SELECT doc_id, label, start FROM (SELECT doc_id, label, start, count(*) AS c FROM stood GROUP BY ALL) JOIN (SELECT label, count(*) AS c FROM sizes GROUP BY label) USING (label, c)
), needed AS (
  SELECT label, {QUORUM} * count(*) AS need, sum(idf) AS idf FROM posts JOIN rare USING (word) WHERE posted GROUP BY label
), found AS (
  SELECT doc_id, label, max(a.idf / t.idf) AS score FROM agreed a JOIN verified USING (doc_id, label, start) JOIN needed t USING (label) WHERE n >= need GROUP BY ALL
), named AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM found WHERE score > 0 UNION ALL SELECT doc_id, label FROM base WHERE label IS NOT NULL) GROUP BY doc_id
), best AS (SELECT doc_id, max(score) AS score FROM found GROUP BY doc_id)
SELECT t.doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(score, 0) END, 6)::DOUBLE AS score
FROM texts t LEFT JOIN based USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN best USING (doc_id)
"""
