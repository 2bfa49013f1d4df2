"""Queries on ledgers, states, gates and dispatch, made of events and orders, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import audit, chapters, control, dispatch, pages, validate
from ..sources import sinks


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lanes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("en", 0), ("de", 1), ("fr", 2), ("es", 3), ("it", 4)], "lane string, position int")


def ledger_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select(F.col("event_type").alias("phase"), F.round(F.col("value") * 100).cast("long").alias("cents"))
    return control.ledger_totals(events, "phase", ["cents"])


def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.latest(_table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], ["event_type", "value"])


def gate_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as recorded gates, all order lines as found ones; those of the least return flag R failed."""
    recorded = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    found = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.min("l_returnflag").alias("f"))
    return control.drift(recorded, found.select("key", F.when(F.col("f") == "R", "FAIL").otherwise("PASS").alias("status")), ["key"])


def next_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = _table(spark, sf_dir, "events").select(F.col("event_id").alias("slug"), F.element_at(F.array(*map(F.lit, (*control.READY, "LOST"))), (F.col("event_id") % (len(control.READY) + 1) + 1).cast("int")).alias("status"))
    return control.next_action(states).groupBy("status", "next").agg(F.count("*").alias("n"))


def rerun_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as gates of their customers, phases by number; all from 3.3 on go stale."""
    phase = F.element_at(F.array(*map(F.lit, control.PHASES)), (F.col("o_orderkey") % len(control.PHASES) + 1).cast("int"))
    gates = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("slug"), phase.alias("phase"), F.col("o_orderstatus").alias("status"))
    return control.rerun(gates, "3.3").select("slug", "phase", "status", F.coalesce("previous", F.lit("")).alias("previous"))


def tree_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.tree_fingerprints(_table(spark, sf_dir, "documents"), "source", "doc_id", "text").select("source", "files", "fingerprint")


def skip_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    now = control.tree_fingerprints(docs, "source", "doc_id", "text")
    before = control.tree_fingerprints(docs.withColumn("text", F.when(F.col("source") == "src3", "changed").otherwise(F.col("text"))), "source", "doc_id", "text")
    return control.unchanged(before, now, "source")


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("long")
    return _table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("events"), F.sum(k).alias("k"), F.count_if(k.isNull()).alias("invalid_entries"))


def marker_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of each user as markers; the user's k-th click is the record of the k-th view."""
    events = _table(spark, sf_dir, "events")
    views = events.filter("event_type = 'view'").select("user_id", "ts", "event_id")
    clicks = events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("t"), F.col("event_id").alias("click"))
    return dispatch.align(views, clicks, ["user_id"], ["ts", "event_id"], ["t", "click"], "click").select("event_id", F.col("k").cast("long").alias("k"), F.coalesce("click", F.lit(-1)).alias("click"))


def unit_lane_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    units = docs.select(F.col("source").alias("unit_id")).distinct()
    plan = dispatch.plan(units, _lanes(spark).filter("lane <> 'es'"))
    return dispatch.coverage(plan, docs.select(F.col("source").alias("unit_id"), F.col("lang").alias("lane")), ["unit_id", "lane"])


def task_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _table(spark, sf_dir, "documents").select(F.concat("source", F.lit("-part"), "source").alias("unit_id")).distinct()
    return dispatch.plan(units, spark.createDataFrame([("defs", 0), ("implementation-details-and-more", 1)], "lane string, position int")).select("unit_id", "lane", "task_id")


def lane_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("lane")).agg(F.count("*").alias("docs"))
    return dispatch.lane_order(rows, _lanes(spark).filter("lane <> 'es'")).select("lane", "docs", F.col("place").cast("long").alias("place"))


def task_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = _table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("chapter"), F.col("o_orderstatus").alias("unit_id"), F.col("o_orderkey").alias("ord"))
    return dispatch.batches(tasks).select("chapter", F.array_join("units", ",").alias("units"), "tasks", F.col("batch").cast("long").alias("batch"))


def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    checks = orders.select(F.col("o_orderpriority").alias("category"), (F.col("o_orderkey") % 3 == 0).alias("manual"), (F.col("o_orderkey") % 5 != 0).alias("passed"), (F.col("o_orderkey") % 2 == 0).alias("acknowledged"))
    return control.audit_summary(checks)


def asset_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return pages.select("page_id", text.asset_name("url").alias("asset"), text.allowed_asset("url", ("example.com",)).alias("allowed"))


def schema_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as declared extraction files, labels as those there are; good quality is valid, a toxic one lost its only quote."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".json")).alias("file")
    found = labels.join(docs.select("doc_id", F.col("source").alias("slug")), "doc_id")
    results = found.select("slug", name, (F.col("quality") == 1).alias("valid"), F.lit(1).alias("extracted"), F.col("toxic").alias("demoted"))
    return validate.schema_batch(docs.select(F.col("source").alias("slug"), name), found.select("slug", name), results)


def manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each source as manifest entries, labelled ones as the files there are; numbers must agree."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    name = F.concat(F.lit("ch-"), F.col("doc_id").cast("string"), F.lit("-x.md")).alias("file")
    there = labels.join(docs.select("doc_id", F.col("source").alias("slug")), "doc_id").select("slug", name)
    found = chapters.manifest_issues(docs.select(F.col("source").alias("slug"), name), there)
    return found.groupBy("slug", "issue").agg(F.count("*").alias("n"))


def pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as books: their orders' states are gates, their segments' first letters the rest; what may go are their orders' prices."""
    c, o = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "orders")
    gates = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderstatus").alias("g"))
    books = c.join(gates, "c_custkey", "left").select(F.col("c_custkey").alias("slug"), (F.col("c_nationkey") % 3).alias("archived"), F.when(F.col("g") == "P", "PASS").when(F.col("g").isNotNull(), "FAIL").alias("gate"), F.when(F.col("c_mktsegment") < "C", "LEGACY_FROZEN").otherwise("DONE").alias("status"), (F.col("c_custkey") % 2).alias("texts"))
    files = o.select(F.col("o_custkey").alias("slug"), F.lit("x").alias("path"), F.col("o_orderkey").alias("length"))
    gone = control.prunable(files, books).select("slug", "files", "bytes")
    return control.prune_gates(books).join(gone, "slug", "left").select("slug", "allowed", "reason", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"))


def archived_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as split units with team folders; those of some nations were moved before, once or twice."""
    s = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("unit_id"), "s_nationkey")
    place = F.concat(F.lit("e/_superseded/phase-3.2/team-"), "unit_id")
    folders = s.filter("s_nationkey % 5 <> 4").select(F.concat(F.lit("e/team-"), "unit_id").alias("path")).union(s.filter("s_nationkey % 3 > 0").select(place)).union(s.filter("s_nationkey % 3 > 1").select(F.concat(place, F.lit(".1"))))
    return control.archived(folders, s, "e")


def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as planned tasks, their numbers as JSON records under several names, order lines as verifications."""
    o, l = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem")
    k = F.col("o_orderkey")
    name = F.concat(F.lit("t"), k)
    body = (
        F.when(k % 4 == 0, F.concat(F.lit('{"jobs": {"'), name, F.lit('": " j'), k, F.lit(' "}}')))
        .when(k % 4 == 1, F.concat(F.lit('{"tasks": [{"id": "'), name, F.lit('", "run_id": "a", "model": "m"}], "runs": [{"task": "'), name, F.lit('", "job": "j'), k, F.lit('", "launcher": "cli"}]}')))
        .when(k % 4 == 2, F.concat(F.lit('{"results": [{"planned_task_id": "'), name, F.lit('", "job_id": "", "native_task_id": "n"}, 5]}')))
        .otherwise("{")
    )
    tasks = o.select(k.cast("string").alias("unit_id"), F.col("o_orderstatus").alias("lane"), name.alias("task_id"))
    checked = l.groupBy(F.col("l_orderkey").cast("string").alias("unit_id")).agg(F.count_if(F.col("l_returnflag") == "R").alias("issues"))
    checked = checked.join(tasks.select("unit_id", "lane"), "unit_id").select("unit_id", "lane", (F.col("issues") == 0).alias("valid"), "issues")
    records = dispatch.normal_records(dispatch.record_rows(o.select(k.alias("ord"), body.alias("json"))))
    out = dispatch.run_manifest(tasks, records, checked)
    return out.select("task_id", "state", "issues", *(F.coalesce(c, F.lit("")).alias(c) for c in ("job_id", "runtime_task_id", "runtime", "model")))


def audit_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as concept pages of a book, short of something by number: how many fail each check, and which come first."""
    d = F.col("doc_id")
    front = F.when(d % 5 == 0, "").otherwise(F.concat(F.lit("---\n"), F.when(d % 4 == 0, 'created: x\ntitle: "x"\n').when(d % 4 == 1, "title: x\ncreated: x\n").otherwise('title: "x"\ncreated: x\n'), F.lit("updated: x\nconfidence: 0."), 90 + d % 10, F.lit("\n"), *(F.lit(f"{k}: x\n") for k in pages.KEYS[4:]), F.lit("---\n")))
    embed = F.concat(F.lit("> ![[c#^src0-ch01-"), d, F.lit("]]\n"))
    body = F.concat(front, F.when(d % 6 != 0, "## author's words\n").otherwise(""), F.repeat(embed, (d % 4).cast("int")), F.when(d % 7 != 0, F.concat(F.lit("## Specific Example\n"), F.when(d % 8 != 0, "^src0-ch01-1").otherwise("^src1-ch01-1"), F.lit("\n## More\n"))).otherwise(""), F.when(d % 9 != 0, "- extracted_from::[[c]]\n").otherwise(""), F.when(d % 11 == 0, "- derived_from::[[c]] src0\n").otherwise(""), F.repeat(F.lit("text\n"), (d % 100).cast("int")))
    made = _table(spark, sf_dir, "documents").select(F.concat(F.lit("p"), d, F.lit(".md")).alias("page"), body.alias("text"))
    out = audit.report(audit.page_checks(made, "src0"), ("PQ-27", "CH-01"), {"PO-42": True})
    return out.select("check_id", "category", "manual", "acknowledged", "passed", "failures", F.array_join("examples", ",").alias("examples"))


def rebuilt_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of all parts' names, as the section of an index that each region begins."""
    parts = _table(spark, sf_dir, "part").select(F.lower("p_name").alias("stem"))
    r = _table(spark, sf_dir, "region").select("r_name")
    old = r.agg(F.concat(F.lit("# Index\n\n> Last updated: never\n\n## Extracted Concepts\n- [[old]]\n\n"), F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("## "), "r_name", F.lit("\ntext\n")))), "")).alias("text"))
    return sinks.rebuilt_index(old, parts, "2024-05-06")


QUERIES = {
    f.__name__: f
    for f in (schema_batch, manifest_check, ledger_rollup, latest_state, gate_drift, next_action, rerun_gates, tree_fingerprint, skip_unchanged, json_props, marker_align, unit_lane_coverage, task_ids, lane_order, task_batches, audit_summary, asset_names, pruning, archived_folders, run_manifest, audit_pages, rebuilt_index)
}

_TREES = """trees AS (SELECT source, count(*) AS files, sha256(string_agg(doc_id::VARCHAR || chr(0) || sha256(coalesce(text, '')) || chr(10), '' ORDER BY doc_id::VARCHAR)) AS fingerprint FROM documents GROUP BY source)"""
_CAMEL = lambda c: f"array_to_string([upper(left(w, 1)) || w[2:] FOR w IN regexp_split_to_array({c}, '[^A-Za-z0-9]+') IF w <> ''], '')"

ORACLES = {
    "schema_batch": """WITH d AS (SELECT DISTINCT source AS slug, doc_id FROM documents), b AS (SELECT slug, doc_id, quality, toxic FROM d LEFT JOIN labels USING (doc_id)), n AS (
          SELECT slug, count(*) AS expected, count(quality) AS total, count(*) FILTER (quality = 1) AS valid, 0::BIGINT AS unexpected, count(*) FILTER (quality IS NULL) AS missing, count(*) FILTER (toxic > 0.2) AS ungrounded FROM b GROUP BY slug)
        SELECT *, expected - valid AS invalid, CASE WHEN valid = expected AND missing = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM n""",
    "manifest_check": """WITH d AS (SELECT source AS slug, count(*) AS n, count(DISTINCT l.doc_id) AS m FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1)
        SELECT slug, 'file missing' AS issue, n - m AS n FROM d WHERE n > m UNION ALL SELECT slug, 'entries and units differ', 1 FROM d WHERE n <> m UNION ALL SELECT slug, 'no units', 1 FROM d WHERE m = 0""",
    "ledger_rollup": "SELECT event_type AS phase, count(*) AS events, sum(round(value * 100))::BIGINT AS cents FROM events GROUP BY ROLLUP (event_type)",
    "latest_state": "SELECT user_id, arg_max(event_type, struct_pack(a := ts, b := event_id)) AS event_type, arg_max(value, struct_pack(a := ts, b := event_id)) AS value FROM events GROUP BY user_id",
    "gate_drift": """WITH r AS (SELECT o_orderkey AS key FROM orders), f AS (SELECT l_orderkey AS key, CASE WHEN min(l_returnflag) = 'R' THEN 'FAIL' ELSE 'PASS' END AS status FROM lineitem GROUP BY 1)
        SELECT * FROM (SELECT coalesce(r.key, f.key) AS key, CASE WHEN f.key IS NULL THEN 'missing gate' WHEN r.key IS NULL THEN 'unrecorded gate' WHEN status <> 'PASS' THEN 'not ready' END AS issue FROM r FULL JOIN f ON r.key = f.key) WHERE issue IS NOT NULL""",
    # by hand: the states in order, as the query deals them out, and one that is none
    "next_action": """WITH n AS (SELECT ['READY_FOR_1', 'READY_FOR_1.5', 'READY_FOR_2', 'READY_FOR_2.1', 'READY_FOR_2.2', 'READY_FOR_2.3', 'READY_FOR_2.4', 'READY_FOR_3.0', 'READY_FOR_3.1', 'READY_FOR_3.2', 'READY_FOR_3.3', 'READY_FOR_3.4', 'READY_FOR_3.5',
          'READY_FOR_4', 'READY_FOR_5', 'READY_FOR_POST', 'AWAITING_USER_CONFIRMATION', 'DONE', 'LEGACY_FROZEN', 'FAILED', 'IN_PROGRESS', 'LOST'][event_id % 22 + 1] AS status FROM events)
        SELECT status, CASE status WHEN 'LOST' THEN 'drift' WHEN 'AWAITING_USER_CONFIRMATION' THEN 'human' WHEN 'FAILED' THEN 'blocked' WHEN 'IN_PROGRESS' THEN 'rerun' WHEN 'DONE' THEN 'none' WHEN 'LEGACY_FROZEN' THEN 'none' ELSE lower(replace(status, 'READY_FOR_', '')) END AS next, count(*) AS n FROM n GROUP BY ALL""",
    "rerun_gates": """WITH g AS (SELECT o_orderkey AS slug, ['1', '1.5', '2.1', '2.2', '2.3', '2.4', '3.0', '3.1', '3.2', '3.3', '3.4', '3.5', '4', '5', 'post'][o_orderkey % 15 + 1] AS phase, o_orderstatus AS s FROM orders)
        SELECT slug, phase, CASE WHEN phase IN ('3.3', '3.4', '3.5', '4', '5', 'post') THEN 'STALE' ELSE s END AS status, CASE WHEN phase IN ('3.3', '3.4', '3.5', '4', '5', 'post') THEN s ELSE '' END AS previous FROM g""",
    "tree_fingerprint": f"WITH {_TREES} SELECT source, files, fingerprint FROM trees",
    "skip_unchanged": f"""WITH {_TREES}, {_TREES.replace('trees', 'before').replace("coalesce(text, '')", "CASE WHEN source = 'src3' THEN 'changed' ELSE coalesce(text, '') END")}
        SELECT source, t.fingerprint = b.fingerprint AS skip FROM trees t JOIN before b USING (source)""",
    "json_props": "SELECT event_type, count(*) AS events, sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k, count(*) FILTER (TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NULL) AS invalid_entries FROM events GROUP BY 1",
    "marker_align": """WITH v AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events WHERE event_type = 'view'), c AS (SELECT event_id AS click, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events WHERE event_type = 'click')
        SELECT event_id, k, coalesce(click, -1) AS click FROM v LEFT JOIN c USING (user_id, k)""",
    "unit_lane_coverage": """WITH e AS (SELECT source AS unit_id, lane FROM (SELECT DISTINCT source FROM documents), (VALUES ('en'), ('de'), ('fr'), ('it')) t(lane)), r AS (SELECT DISTINCT source AS unit_id, lang AS lane FROM documents)
        SELECT unit_id, lane, 'missing' AS issue FROM (FROM e EXCEPT FROM r) UNION ALL SELECT unit_id, lane, 'extra' FROM (FROM r EXCEPT FROM e)""",
    "task_ids": f"""WITH n AS (SELECT unit_id, lane, {_CAMEL('lane')} || {_CAMEL('unit_id')} AS name FROM (SELECT DISTINCT source || '-part' || source AS unit_id FROM documents), (VALUES ('defs'), ('implementation-details-and-more')) t(lane))
        SELECT unit_id, lane, CASE WHEN length(name) <= 32 THEN name ELSE left(name, 26) || upper(left(sha1(lane || ':' || unit_id), 6)) END AS task_id FROM n""",
    "lane_order": "SELECT lang AS lane, count(*) AS docs, CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE 5 END::BIGINT AS place FROM documents GROUP BY lang",
    "task_batches": "SELECT o_orderpriority AS chapter, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS units, count(*) AS tasks, row_number() OVER (ORDER BY min(o_orderkey)) AS batch FROM orders GROUP BY 1",
    "audit_summary": """SELECT category, count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed, count(*) FILTER (manual) AS manual
        FROM (SELECT o_orderpriority AS category, o_orderkey % 3 = 0 AS manual, o_orderkey % 5 <> 0 AND (o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0) AS ok FROM orders) GROUP BY 1""",
    "asset_names": r"""SELECT page_id, 'crop-' || left(sha1(url), 16) || coalesce(nullif(regexp_extract(lower(regexp_replace(url, '[?#].*$', '')), '(\.(?:png|jpe?g|webp|gif))$', 1), ''), '.png') AS asset,
        regexp_matches(url, '^https://([^/?#]*\.)?example\.com([/?#]|$)') AS allowed FROM pages""",
    "pruning": """WITH g AS (SELECT o_custkey AS k, max(o_orderstatus) AS g, count(*) AS n, sum(o_orderkey)::BIGINT AS b FROM orders GROUP BY 1), c AS (SELECT c_custkey AS slug, c_nationkey % 3 > 0 AS kept, coalesce(g = 'P', false) AS ok, c_mktsegment < 'C' AS frozen, c_custkey % 2 > 0 AS texts, n, b FROM customer LEFT JOIN g ON k = c_custkey)
        SELECT slug, kept AND (ok OR (frozen AND texts)) AS allowed, CASE WHEN NOT kept THEN 'no archived source' WHEN ok THEN 'gate passed' WHEN frozen AND texts THEN 'frozen with extracted text' WHEN frozen THEN 'frozen without extracted text' ELSE 'no passed gate and not frozen' END AS reason,
          CASE WHEN allowed THEN coalesce(n, 0) ELSE 0 END AS files, CASE WHEN allowed THEN coalesce(b, 0) ELSE 0 END AS bytes FROM c""",
    "archived_folders": "SELECT s_suppkey::VARCHAR AS unit_id, 'e/team-' || s_suppkey AS path, 'e/_superseded/phase-3.2/team-' || s_suppkey || ['', '.1', '.2'][s_nationkey % 3 + 1] AS moved_to FROM supplier WHERE s_nationkey % 5 <> 4",
    "run_manifest": """WITH l AS (SELECT l_orderkey AS k, count(*) FILTER (l_returnflag = 'R') AS issues FROM lineitem GROUP BY 1), m AS (SELECT o_orderkey AS k, issues, CASE WHEN o_orderkey % 4 < 2 THEN 'j' || o_orderkey ELSE '' END AS job_id FROM orders LEFT JOIN l ON k = o_orderkey)
        SELECT 't' || k AS task_id, CASE WHEN job_id = '' THEN 'unrecorded' WHEN issues IS NULL THEN 'unverified' WHEN issues > 0 THEN 'invalid' ELSE 'valid' END AS state, coalesce(issues, 0) AS issues, job_id,
          CASE WHEN k % 4 = 2 THEN 'n' ELSE '' END AS runtime_task_id, CASE WHEN k % 4 = 1 THEN 'cli' ELSE '' END AS runtime, CASE WHEN k % 4 = 1 THEN 'm' ELSE '' END AS model FROM m""",
    "audit_pages": """WITH d AS (SELECT doc_id AS d, 'p' || doc_id || '.md' AS p FROM documents), x AS (SELECT *, CASE WHEN d % 5 = 0 THEN 0 ELSE 12 END + (d % 6 <> 0)::INT + d % 4 + CASE WHEN d % 7 <> 0 THEN 3 ELSE 0 END + (d % 9 <> 0)::INT + (d % 11 = 0)::INT + d % 100 AS n FROM d),
        f AS (SELECT 'SC-21' AS k, p FROM x WHERE d % 5 = 0 OR d % 4 = 0 UNION ALL SELECT 'PQ-23', p FROM x WHERE d % 4 < 2 UNION ALL SELECT 'PQ-24', p FROM x WHERE d % 6 = 0 UNION ALL SELECT 'PQ-28', p FROM x WHERE d % 7 = 0 OR d % 8 = 0 UNION ALL SELECT 'PQ-36', p FROM x WHERE n < 80
          UNION ALL SELECT 'PQ-37', p FROM x WHERE d % 9 = 0 OR d % 11 = 0 UNION ALL SELECT 'PQ-39', p FROM x WHERE d % 5 <> 0 AND d % 4 = 1 UNION ALL SELECT 'PO-46', p FROM x WHERE n < 80 OR d % 4 < 2 UNION ALL SELECT 'WI-50', p FROM x WHERE d % 5 <> 0 AND d % 10 > 5),
        g AS (SELECT k, count(*) AS n, array_to_string(list(p ORDER BY p)[:5], ',') AS e FROM f GROUP BY k),
        c AS (SELECT unnest(['CH-01', 'CH-02', 'CH-03', 'CH-04', 'EX-06', 'EX-08', 'EX-09', 'EX-10', 'EX-11', 'EX-12', 'EX-13', 'EX-14', 'SC-15', 'SC-16', 'SC-17', 'SC-18', 'SC-19', 'SC-20', 'SC-21', 'SC-22', 'PQ-23', 'PQ-24', 'PQ-27', 'PQ-28', 'PQ-29', 'PQ-30', 'PQ-31', 'PQ-32', 'PQ-33', 'PQ-34',
          'PQ-35', 'PQ-36', 'PQ-37', 'PQ-38', 'PQ-39', 'PO-42', 'PO-44', 'PO-45', 'PO-46', 'WI-47', 'WI-48', 'WI-49', 'WI-50', 'WI-51']) AS k)
        SELECT k AS check_id, CASE left(k, 2) WHEN 'CH' THEN 'Phase 1-2' WHEN 'EX' THEN 'Phase 3' WHEN 'PQ' THEN 'Page Quality' WHEN 'PO' THEN 'Post-Ingest' WHEN 'WI' THEN 'Wiki Integrity' ELSE CASE WHEN k < 'SC-20' THEN 'Phase 4' WHEN k = 'SC-20' THEN 'Phase 4-5' ELSE 'Phase 5' END END AS category,
          k IN ('CH-01', 'EX-06', 'EX-09', 'EX-13', 'EX-14', 'PQ-27', 'PQ-29', 'PQ-30', 'PQ-31', 'PQ-32', 'PQ-33', 'PQ-34', 'PQ-35') AS manual, k IN ('PQ-27', 'CH-01') AS acknowledged, n IS NULL AND k <> 'SC-22' AS passed, coalesce(n, 0) AS failures, coalesce(e, '') AS examples FROM c LEFT JOIN g USING (k)""",
    "rebuilt_index": """WITH s AS (SELECT count(DISTINCT lower(p_name)) AS n, string_agg(DISTINCT '- [[' || lower(p_name) || ']]', chr(10) ORDER BY '- [[' || lower(p_name) || ']]') AS l FROM part), r AS (SELECT string_agg('## ' || r_name || chr(10) || 'text', chr(10) ORDER BY r_name) AS t FROM region)
        SELECT '# Index' || chr(10) || chr(10) || '> Last updated: 2024-05-06 | ' || n || ' concept pages' || chr(10) || chr(10) || '## Extracted Concepts' || chr(10) || l || chr(10) || t || chr(10) AS markdown FROM s, r""",
}
