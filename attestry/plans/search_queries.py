"""Queries by nearness: vectors, reachability and cycles of links, lines in ranges, states as of an event; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocks, chapters, intervals, reach, vectors
from .text_queries import ORACLES as TEXT_ORACLES


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All vectors, and as queries those whose id is divisible by 20."""
    own = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return own, own.filter("id % 20 = 0")


def embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most like vectors of each query, exactly."""
    found = vectors.neighbours(*_vectors(spark, sf_dir))
    return found.select(F.col("id").alias("vec_id"), "neighbour", F.round(F.col("similarity") * 1_000_000).cast("long").alias("millionths"), "rank")


def embedding_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from as many nearest cells only as hold 95 per cent of the neighbours of a sample of the queries."""
    found = vectors.neighbours(*_vectors(spark, sf_dir), recall=0.95)
    return found.select(F.col("id").alias("vec_id"), "neighbour", F.round(F.col("similarity") * 1_000_000).cast("long").alias("millionths"), "rank")


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders and parts as pages, links, and the index: an order leads to its lines' parts, a part to the order of its number; the first order is the index."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.concat(F.lit("o"), "o_orderkey").alias("node"), "o_orderkey")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.concat(F.lit("p"), "p_partkey").alias("node"), F.concat(F.lit("o"), "p_partkey").alias("next"))
    down = lines.select(F.concat(F.lit("o"), "l_orderkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst"))
    up = parts.select(F.col("node").alias("src"), F.col("next").alias("dst")).join(orders.select(F.col("node").alias("dst")), "dst", "left_semi")
    index = orders.agg(F.min("o_orderkey").alias("k")).filter("k is not null").select(F.concat(F.lit("o"), "k").alias("node"))
    return orders.select("node").union(parts.select("node")), down.unionByName(up), index


def reachable_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, edges, index = _graph(spark, sf_dir)
    return reach.reachable(edges, index)


def orphan_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reach.orphans(*_graph(spark, sf_dir))


def edge_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that refer to each other: untaxed small lines lead from their supplier to that of their part's number."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_quantity <= 3 and l_tax = 0")
    return reach.cycles(lines.select(F.col("l_suppkey").alias("src"), F.expr("l_partkey div 20").alias("dst")))


def lines_in_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, brought to the part that holds it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    parts = chapters.size_split(docs, "doc_id", 20, 3).select("doc_id", "part", F.col("line_start").alias("start"), (F.col("line_end") + 1).alias("end"))
    rows = blocks.explode_lines(docs, ["doc_id"]).select("doc_id", F.col("line_no").cast("long").alias("at"), F.length("line").alias("chars"))
    found = intervals.in_ranges(rows, parts, ["doc_id"])
    return found.groupBy("doc_id", "part").agg(F.count("*").alias("lines"), F.sum("at").alias("places"), F.sum("chars").alias("chars"))


def event_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last error of the same user at or before each other event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", F.expr("unix_micros(cast(ts as timestamp))").alias("at"))
    errors = events.filter("event_type = 'error'").select("user_id", F.col("at").alias("since"), F.col("event_id").alias("error_id"))
    found = intervals.as_of(events.filter("event_type <> 'error'").select("event_id", "user_id", "at"), errors, "user_id", "at", "since", width=3_600_000_000)
    return found.select("event_id", F.col("state.error_id").alias("error_id"), (F.col("at") - F.col("state.since")).alias("age"))


QUERIES = {f.__name__: f for f in (embedding_neighbours, embedding_search, reachable_pages, orphan_pages, edge_cycles, lines_in_units, event_states)}

_GRAPH = """pages AS (SELECT 'o' || o_orderkey AS node FROM orders UNION ALL SELECT 'p' || p_partkey FROM part), edges AS (
  SELECT DISTINCT 'o' || l_orderkey AS src, 'p' || l_partkey AS dst FROM lineitem UNION SELECT 'p' || p_partkey, 'o' || o_orderkey FROM part JOIN orders ON o_orderkey = p_partkey
), walk(node, distance) AS (
  SELECT 'o' || min(o_orderkey), 0::BIGINT FROM orders UNION SELECT dst, distance + 1 FROM walk JOIN edges ON src = node WHERE distance < 40
), reached AS (SELECT node, min(distance) AS distance FROM walk GROUP BY node)"""

ORACLES = {
    "embedding_neighbours": """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), pairs AS (
          SELECT a.vec_id, b.vec_id AS neighbour, round(list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)), 6) AS s FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
        SELECT vec_id, neighbour, round(s * 1000000)::BIGINT AS millionths, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, neighbour) AS rank FROM pairs QUALIFY rank <= 10""",
    "reachable_pages": f"WITH RECURSIVE {_GRAPH} SELECT node, distance FROM reached",
    "orphan_pages": f"WITH RECURSIVE {_GRAPH} SELECT node, node IN (SELECT dst FROM edges WHERE src <> dst) AS linked FROM pages WHERE node NOT IN (SELECT node FROM reached)",
    "edge_cycles": """WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS src, l_partkey // 20 AS dst FROM lineitem WHERE l_quantity <= 3 AND l_tax = 0), walk(a, b) AS (SELECT src, dst FROM e UNION SELECT a, dst FROM walk JOIN e ON src = b),
        both_ways AS (SELECT x.a AS node, x.b AS other FROM walk x JOIN walk y ON x.a = y.b AND x.b = y.a)
        SELECT node, min(other) AS cycle, count(DISTINCT other) AS size FROM both_ways GROUP BY node""",
    "lines_in_units": f"""SELECT doc_id, part, count(*) AS lines, sum(line_no)::BIGINT AS places, sum(length(line))::BIGINT AS chars
        FROM ({TEXT_ORACLES["size_split"]}) p JOIN ({TEXT_ORACLES["line_explode"]}) l USING (doc_id) WHERE line_no BETWEEN line_start AND line_end GROUP BY ALL""",
    "event_states": """WITH errs AS (SELECT user_id, ts, max(event_id) AS error_id FROM events WHERE event_type = 'error' GROUP BY ALL)
        SELECT event_id, error_id, epoch_us(e.ts) - epoch_us(s.ts) AS age FROM (SELECT * FROM events WHERE event_type <> 'error') e ASOF LEFT JOIN errs s ON e.user_id = s.user_id AND e.ts >= s.ts""",
}
