"""Queries on histories, versions, runs, folders, chunks, gates, sketches and cubes, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import blocks, chapters, sketches, trees
from ..sources import gated, scratch, versions
from ..streaming import runs
from .text_queries import _CLASSED, files


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("at", F.expr("unix_micros(cast(ts as timestamp))"))


def state_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of equal event types of each user, with validity."""
    return versions.state_history(_events(spark, sf_dir), "user_id", ["at", "event_id"], "event_type")


def versioned_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users' last types and counts after each half of the events, committed as two versions of a history; what was valid at each."""
    events, path = _events(spark, sf_dir), f"{scratch.shared_dir(spark)}/attestry/versions-{uuid.uuid4().hex}"
    half = events.agg(F.floor((F.min("event_id") + F.max("event_id")) / 2).alias("h")).first().h or 0
    state = lambda df: df.groupBy("user_id").agg(F.max_by("event_type", F.struct("at", "event_id")).alias("state"))
    first = versions.commit(versions.opened(state(events.filter(F.col("event_id") <= half)), F.lit(1)), path, 0)
    versions.commit(versions.advanced(versions.read(spark, path, first), state(events), ["user_id"], F.lit(2)), path, first)
    history = versions.read(spark, path)
    return versions.as_of(history, F.lit(1)).withColumn("moment", F.lit(1)).union(versions.as_of(history, F.lit(2)).withColumn("moment", F.lit(2)))


def run_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of each user's events at most an hour apart: what the stream of the same events emits."""
    return runs.run_spans(_events(spark, sf_dir), "user_id", "ts", 3600)


def changed_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files by language, source and hundred; every 97th is changed, every 89th goes, every 83rd comes under another name."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = F.concat_ws("/", F.coalesce("lang", F.lit("none")), "source", F.expr("doc_id div 100"))
    old = docs.select(F.concat(folder, F.lit("/"), "doc_id").alias("path"), F.col("text").alias("content"))
    name = F.concat(folder, F.lit("/"), "doc_id", F.when(F.col("doc_id") % 83 == 1, "b").otherwise(""))
    new = docs.filter("doc_id % 89 <> 0").select(name.alias("path"), F.when(F.col("doc_id") % 97 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit("!"))).otherwise(F.col("text")).alias("content"))
    return trees.tree_diff(trees.digests(old), trees.digests(new))


def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as pages of seven books, five thousand times as large; the chunks in which they are read."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select((F.col("page_id") % 7).alias("book"), "page_id", (F.octet_length("html") * 5000).alias("size"))
    found = chapters.chunk_plan(pages, "book", "page_id", "size")
    return found.select("book", F.col("chunk").cast("long"), F.col("first").cast("long"), F.col("last").cast("long"), "bytes", "too_large")


def one_pass_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written through a gate: what was measured on the way, beside what stands in the table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = f"{scratch.shared_dir(spark)}/attestry/gated-{uuid.uuid4().hex}"
    metrics = {"texts": F.count("*"), "chars": F.sum(F.length("text").cast("long")), "empty": F.count_if(text.strip(F.coalesce("text", F.lit(""))) == ""), "missing": F.count_if(F.col("lang").isNull())}
    found = gated.gated_write(docs.select("doc_id", "text", "lang"), path, metrics, {"fidelity": lambda m: m["empty"] <= 0.5 * m["texts"]})
    measured = [F.lit(found[c]).cast("long").alias(c) for c in metrics]
    return spark.read.parquet(path).agg(F.count("*").alias("written"), F.count_distinct("doc_id").alias("ids")).select(*measured, "written", "ids")


def sketch_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of each source and language, merged by source: different words' number and quantiles of lengths, without rereading."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = docs.select("source", "lang", F.explode(F.split(F.coalesce("text", F.lit("")), r"\s+")).alias("word")).filter("word <> ''")
    made = sketches.sketched(words.withColumn("n", F.length("word")), ["source", "lang"], "word", "n")
    return sketches.estimates(sketches.merged(made, ["source"]), ["source"])


def evidence_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks and files by source, tens of chapters and category, at four levels."""
    found = blocks.classify(blocks.new_blocks(blocks.spread(files(spark, sf_dir)))).withColumn("chapter", F.expr("chapter div 10"))
    return blocks.evidence_cube(found, "slug", "chapter")


QUERIES = {f.__name__: f for f in (state_history, versioned_states, run_spans, changed_folders, chunk_plan, one_pass_gates, sketch_rollup, evidence_cube)}

_TREE = """leaves AS (SELECT version, path, sha256(content) AS digest FROM (
    SELECT 1 AS version, coalesce(lang, 'none') || '/' || source || '/' || doc_id // 100 || '/' || doc_id AS path, coalesce(text, '') AS content FROM documents
    UNION ALL SELECT 2, coalesce(lang, 'none') || '/' || source || '/' || doc_id // 100 || '/' || doc_id || CASE WHEN doc_id % 83 = 1 THEN 'b' ELSE '' END, coalesce(text, '') || CASE WHEN doc_id % 97 = 0 THEN '!' ELSE '' END FROM documents WHERE doc_id % 89 <> 0)
), """
_UP = "SELECT version, regexp_replace(path, '(^|/)[^/]*$', '') AS path, sha256(string_agg(string_split(path, '/')[-1] || chr(0) || digest || chr(10), '' ORDER BY string_split(path, '/')[-1])) AS digest FROM {below} GROUP BY ALL"

ORACLES = {
    "state_history": """WITH e AS (SELECT user_id, event_type, epoch_us(ts) AS t, event_id, lag(event_type) OVER o IS DISTINCT FROM event_type AS new FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)),
          r AS (SELECT *, sum(new::INT) OVER (PARTITION BY user_id ORDER BY t, event_id) AS run FROM e), s AS (SELECT user_id, run, event_type, min(t) AS valid_from, count(*) AS events FROM r GROUP BY ALL)
        SELECT user_id, event_type, valid_from, lead(valid_from) OVER (PARTITION BY user_id ORDER BY run) AS valid_to, events FROM s""",
    "versioned_states": """WITH h AS (SELECT floor((min(event_id) + max(event_id)) / 2) AS h FROM events)
        SELECT user_id, arg_max(event_type, struct_pack(a := ts, b := event_id)) AS state, 1 AS moment FROM events, h WHERE event_id <= h GROUP BY user_id
        UNION ALL SELECT user_id, arg_max(event_type, struct_pack(a := ts, b := event_id)), 2 FROM events GROUP BY user_id""",
    "run_spans": """WITH e AS (SELECT user_id, epoch_us(ts) AS t, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) > 3600000000, true) AS new FROM events),
          r AS (SELECT *, sum(new::INT) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS run FROM e)
        SELECT user_id, min(t) AS started, max(t) AS ended, count(*) AS events FROM r GROUP BY user_id, run""",
    "changed_folders": f"""WITH {_TREE} three AS ({_UP.format(below="leaves")}), two AS ({_UP.format(below="three")}), one AS ({_UP.format(below="two")}), root AS ({_UP.format(below="one")}),
          every AS (SELECT *, false AS folder FROM leaves UNION ALL SELECT *, true FROM (SELECT * FROM three UNION ALL SELECT * FROM two UNION ALL SELECT * FROM one UNION ALL SELECT * FROM root))
        SELECT path, folder, CASE WHEN a.digest IS NULL THEN 'added' WHEN b.digest IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM (SELECT * FROM every WHERE version = 1) a FULL JOIN (SELECT * FROM every WHERE version = 2) b USING (path, folder) WHERE a.digest IS DISTINCT FROM b.digest""",
    "chunk_plan": f"""WITH RECURSIVE p AS (SELECT page_id % 7 AS book, row_number() OVER (PARTITION BY page_id % 7 ORDER BY page_id) AS n, octet_length(encode(html)) * 5000 AS size FROM pages),
          c AS (SELECT book, n, sum(size) OVER (PARTITION BY book ORDER BY n)::BIGINT AS upto FROM p UNION ALL SELECT DISTINCT book, 0, 0 FROM p), k AS (SELECT book, max(n) AS pages FROM c GROUP BY book),
          walk(book, lo, hi) AS (SELECT book, 1::BIGINT, least(pages, {chapters.CHUNK_PAGES}) FROM k UNION ALL
            SELECT w.book, CASE WHEN ok THEN hi + 1 ELSE lo END, CASE WHEN ok THEN least(pages, hi + {chapters.CHUNK_PAGES}) ELSE greatest(lo, lo + (hi - lo) // 2 - 1) END
            FROM (SELECT x.*, h.upto - l.upto <= {chapters.CHUNK_BYTES} OR hi = lo AS ok FROM walk x JOIN c h ON h.book = x.book AND h.n = hi JOIN c l ON l.book = x.book AND l.n = lo - 1) w JOIN k ON k.book = w.book WHERE NOT ok OR hi < pages),
          done AS (SELECT x.book, lo, hi, h.upto - l.upto AS bytes FROM walk x JOIN c h ON h.book = x.book AND h.n = hi JOIN c l ON l.book = x.book AND l.n = lo - 1 WHERE h.upto - l.upto <= {chapters.CHUNK_BYTES} OR hi = lo)
        SELECT book, row_number() OVER (PARTITION BY book ORDER BY lo) AS chunk, lo AS first, hi AS last, bytes, bytes > {chapters.CHUNK_BYTES} AS too_large FROM done""",
    "one_pass_gates": r"""SELECT count(*) AS texts, sum(length(text))::BIGINT AS chars, count(*) FILTER (regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') = '') AS empty, count(*) FILTER (lang IS NULL) AS missing, count(*) AS written, count(DISTINCT doc_id) AS ids FROM documents""",
    "evidence_cube": f"""WITH {_CLASSED}, b AS (SELECT source AS slug, doc_id // 10 AS chapter, category, doc_id FROM classed)
        SELECT slug, chapter, category, GROUPING_ID(slug, chapter, category) AS level, count(*) AS blocks, count(DISTINCT doc_id) AS files FROM b
        GROUP BY GROUPING SETS ((slug, chapter, category), (slug, category), (slug), ())""",
}
