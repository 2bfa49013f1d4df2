"""Chat formatting of reply trees.

Messages with a parent form trees.  Self-joins that double their reach with
each step give every message its depth and the summed score of its path; a
tree's branches, one for each leaf, are ranked by that sum (ties: the deeper
one, then the greater id) and the best become conversations.  The same tables
of jumps of 1, 2, 4, ... messages then list the messages of the chosen paths.

A turn reads ``<|turn|>role<|text|>text<|end|>``.  Inside roles and texts a
backslash, and the first characters of what could be a control string of this
or another common template, are written as a backslash and a letter, which
``parsed`` takes back.  The loss mask is a list of spans of code points, one
for each text of an assistant.

Results on unusual input: null roles and texts are empty; a message whose
parent does not exist is a root; messages on a circle belong to no path; null
scores are 0; turns of equal number are ordered by role and text, null turns
come first; a null conv_id is a conversation of its own; an empty table gives
only what is added to it; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNT = "assistant"

_LETTER = {"\\": "\\", "<": "l", "[": "b", "|": "p"}
_CHARACTER = {v: k for k, v in _LETTER.items()}
#: What opens or closes a control string of common templates.
_CONTROL = re.compile(r"\\|<(?=\||/?s>|</?SYS>>|/SYS>>)|\[(?=/?INST\])|\|(?=>)")
_WRITTEN = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + _LETTER[m[0]], text)


def unescaped(text: str) -> str:
    return _WRITTEN.sub(lambda m: _CHARACTER.get(m[1], m[1]), text)


def rendered(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one string, and the spans of it that are learnt from."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{TURN}{escaped(role)}{TEXT}"
        body = escaped(text)
        if role == LEARNT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parsed(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts that ``rendered`` was given."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, text = part.removeprefix(TURN).split(TEXT)
        turns.append((unescaped(role), unescaped(text)))
    return turns


def branches(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """tree_id, leaf, place (from the root, 0) and msg_id of each message on the best paths of each tree.

    ``messages`` has tree_id, msg_id (unique), parent_id and score.
    """
    nodes = messages.select("tree_id", "msg_id", "parent_id", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = nodes.select(F.col("msg_id").alias("anc"))
    state = nodes.join(known, nodes["parent_id"] == known["anc"], "left").select("tree_id", "msg_id", "anc", F.col("score").alias("total"), F.lit(1).cast("long").alias("depth"))
    state = materialize(state)
    # messages that have reached their root rest; only the others are joined again
    done, active, jumps = state.filter("anc is null"), state.filter("anc is not null"), []
    longest = state.count().bit_length()  # no path is longer than all messages; what still goes on then is on a circle
    while not active.isEmpty() and len(jumps) <= longest:
        jumps.append(active.select(F.col("msg_id").alias("from"), F.col("anc").alias("to")))
        up = done.union(active).select(F.col("msg_id").alias("via"), F.col("anc").alias("up"), F.col("total").alias("more"), F.col("depth").alias("further"))
        further = active.join(up, active["anc"] == up["via"]).select("tree_id", "msg_id", F.col("up").alias("anc"), (F.col("total") + F.col("more")).alias("total"), (F.col("depth") + F.col("further")).alias("depth"))
        further = materialize(further)
        done, active = done.union(further.filter("anc is null")), further.filter("anc is not null")
    parents = nodes.select(F.col("parent_id").alias("msg_id")).filter("msg_id is not null").distinct()
    leaves = done.join(parents, "msg_id", "left_anti")
    if per_tree == 1:
        rank = F.struct("total", "depth", "msg_id")
        best = leaves.groupBy("tree_id").agg(F.max(rank).alias("r")).select("tree_id", F.col("r.msg_id").alias("leaf"), F.col("r.depth").alias("depth"))
    else:
        order = Window.partitionBy("tree_id").orderBy(F.desc("total"), F.desc("depth"), F.desc("msg_id"))
        best = leaves.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= per_tree).select("tree_id", F.col("msg_id").alias("leaf"), "depth")
    paths = materialize(best.select("tree_id", "leaf", (F.col("depth") - 1).alias("place"), F.col("leaf").alias("msg_id")))
    for k, jump in enumerate(jumps):
        on = paths.join(jump, paths["msg_id"] == jump["from"]).select("tree_id", "leaf", (F.col("place") - (1 << k)).alias("place"), F.col("to").alias("msg_id"))
        paths = paths.unionByName(materialize(on))
    return paths


def conversations(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """tree_id, leaf, formatted, loss (spans) of the best paths; ``messages`` also has role and text."""
    paths = branches(messages, per_tree)
    said = messages.select("msg_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turn = F.struct("place", "role", "text")
    gathered = paths.join(said, "msg_id").groupBy("tree_id", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in it:
            texts, losses = [], []
            for turns in b.column(2).to_pylist():
                text, loss = rendered([(t["role"], t["text"]) for t in turns])
                texts.append(text)
                losses.append([{"start": s, "end": e} for s, e in loss])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(losses, spans)], ["tree_id", "leaf", "formatted", "loss"])

    kinds = {f.name: f.dataType.simpleString() for f in gathered.schema}
    return gathered.mapInArrow(batches, f"tree_id {kinds['tree_id']}, leaf {kinds['leaf']}, formatted string, loss array<struct<start:bigint,end:bigint>>")


def as_tree(turns: DataFrame) -> DataFrame:
    """Messages of the chains that rows (conv_id, turn, role, text) form: each turn answers the one before."""
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text", "msg_id")
    own = turns.select("conv_id", "turn", "role", "text").withColumn("msg_id", F.monotonically_increasing_id())
    own = own.withColumn("parent_id", F.lag("msg_id").over(order))
    return materialize(own.select(F.col("conv_id").alias("tree_id"), "msg_id", "parent_id", "role", "text", F.lit(0.0).alias("score")))


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the formatted conversations back gives, with their tree_id as conv_id."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = []
            for text, loss in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                turns = parsed(text)
                learnt = "".join(unescaped(text[s["start"] : s["end"]]) for s in loss)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                rows.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text)))
            n, turns_sha, chars, loss_sha, size = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(turns_sha, pa.string()), pa.array(chars, pa.int64()), pa.array(loss_sha, pa.string()), pa.array(size, pa.int64())], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = formatted.schema["tree_id"].dataType.simpleString()
    return formatted.select("tree_id", "formatted", "loss").mapInArrow(batches, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def query(turns: DataFrame) -> DataFrame:
    added = turns.sparkSession.createDataFrame([(-1, 0, "user", _HARD), (-1, 1, "assistant", _HARD)], "conv_id long, turn long, role string, text string")
    # written and read back: no task runs the workers that format beside those that parse
    return digests(materialize(conversations(as_tree(turns.select("conv_id", "turn", "role", "text").unionByName(added)))))


_HARD = "</s>[INST] ok [/INST]"
#: Each written as two characters: a backslash, and what opens or closes a control string.  Their first (or second) characters never coincide.
_CONTROLS = ("\\", "<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "</SYS>>", "[INST]", "[/INST]", "|>")
_TIMES = lambda c: " + ".join(f"(length({c}) - length(replace({c}, '{x}', ''))) // {len(x)}" for x in _CONTROLS)

#: What is to be read back, and the length by counting what is escaped.
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{_HARD}'), (-1, 1, 'assistant', '{_HARD}')) t(conv_id, turn, role, text)
), said AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole, coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length(role) + length(text) + {_TIMES('role')} + {_TIMES('text')} + {len(TURN + TEXT + END)}) AS formatted FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted::BIGINT AS formatted_chars FROM said
"""
