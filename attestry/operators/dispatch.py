"""Dispatch: units by lanes, plans and records, ordinal alignment, batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text

# Other names that records use.
ALIASES = {
    "job_id": ("job_id", "run_id", "job"),
    "runtime_task_id": ("runtime_task_id", "task_id", "native_task_id"),
    "runtime": ("runtime", "actual_runtime_tool", "launcher"),
    "model": ("model", "actual_model", "model_id"),
}


def plan(units: DataFrame, lanes: DataFrame) -> DataFrame:
    """A task for each unit and lane; lanes are a configuration of a few rows."""
    tasks = units.select("unit_id").crossJoin(F.broadcast(lanes.select("lane", "position")))
    return tasks.select("unit_id", "lane", "position", text.lane_task_id("lane", "unit_id").alias("task_id"))


def coverage(expected: DataFrame, recorded: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and issue: expected pairs that are missing, recorded ones that are extra."""
    e = expected.select(*keys).distinct().withColumn("e", F.lit(True))
    r = recorded.select(*keys).distinct().withColumn("r", F.lit(True))
    both = e.join(r, keys, "full_outer").filter("e is null or r is null")
    return both.select(*keys, F.when(F.col("e").isNull(), "extra").otherwise("missing").alias("issue"))


def record_rows(results: DataFrame) -> DataFrame:
    """id, ord and the fields of ``ALIASES`` under all their names, one row for each record of dispatch results (ord, json).

    Jobs are a map from id to a job id or a record; tasks, results and runs are lists, later ones over earlier ones.
    """
    v = results.select("ord", F.try_parse_json("json").alias("v"))
    get = lambda c, k: F.try_variant_get(c, f"$.{k}", "string")
    names = sorted({n for ns in ALIASES.values() for n in ns} | {"planned_task_id", "task"})
    jobs = v.select("ord", F.explode(F.expr("try_cast(try_variant_get(v, '$.jobs', 'variant') as map<string, variant>)")).alias("id", "r"))
    plain = F.when(F.schema_of_variant("r") == "STRING", F.try_variant_get("r", "$", "string"))
    fields = [F.coalesce(plain, get("r", n)).alias(n) if n == "job_id" else get("r", n).alias(n) for n in names]
    out = jobs.select("id", F.struct("ord", F.lit(0).alias("list"), F.lit(0).alias("pos")).alias("ord"), *fields)
    for k, name in enumerate(("tasks", "results", "runs"), 1):
        rows = v.select("ord", F.posexplode(F.try_variant_get("v", f"$.{name}", "array<variant>")).alias("pos", "r")).filter(F.schema_of_variant("r").startswith("OBJECT"))
        out = out.unionByName(rows.select(get("r", "id").alias("id"), F.struct("ord", F.lit(k).alias("list"), "pos").alias("ord"), *(get("r", n).alias(n) for n in names)))
    return out


def normal_records(records: DataFrame) -> DataFrame:
    """One record an id: aliases read, later rows (ord) over earlier ones, field by field."""
    given = lambda c: F.nullif(text.strip(c), F.lit(""))
    task = [given(c) for c in ("id", "planned_task_id", "task") if c in records.columns]
    df = records.withColumn("id", F.coalesce(*task)).filter("id is not null")
    fields = {k: F.coalesce(F.lit(None).cast("string"), *(given(c) for c in names if c in records.columns)) for k, names in ALIASES.items()}
    df = df.select("id", "ord", *(v.alias(k) for k, v in fields.items()))
    return df.groupBy("id").agg(*(F.max_by(k, F.when(F.col(k).isNotNull(), F.col("ord"))).alias(k) for k in ALIASES))


def record_issues(tasks: DataFrame, records: DataFrame) -> DataFrame:
    """task_id and issue of planned tasks without a record, or whose ids are missing or made up."""
    df = tasks.select("task_id").join(records.withColumnRenamed("id", "task_id"), "task_id", "left")
    need = lambda c: F.when(F.col(c).isNull(), f"missing {c}").when(text.is_synthetic_id(c, "task_id"), f"synthetic {c}")
    issues = F.array_compact(F.array(need("job_id"), need("runtime_task_id"), F.when(F.col("runtime").isNull(), "missing runtime")))
    return df.select("task_id", F.explode(issues).alias("issue"))


def align(markers: DataFrame, records: DataFrame, keys: list[str], order_left: list[str], order_right: list[str], value: str) -> DataFrame:
    """``markers`` with ordinal k and the k-th record's ``value`` of the same keys."""
    nth = lambda order: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    left = markers.withColumn("k", nth(order_left))
    right = records.withColumn("k", nth(order_right)).select(*keys, "k", value)
    return left.join(right, [*keys, "k"], "left")


def batches(tasks: DataFrame) -> DataFrame:
    """chapter, batch (first seen first), its sorted units and its number of tasks; ``tasks`` has chapter, unit_id and ord.

    Chapters are numbered by counting: of a chapter's first places, the high halves are counted together and
    only those of one high half are ordered against each other.
    """
    groups = tasks.groupBy("chapter").agg(F.min("ord").alias("seen"), F.array_sort(F.collect_set("unit_id")).alias("units"), F.count("*").alias("tasks"))
    high = groups.withColumn("high", F.shiftright(F.col("seen").cast("long"), 20))
    counts = high.groupBy("high").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("high").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("high").orderBy("seen", "chapter"))
    out = high.withColumn("place", place).join(counts.select("high", before.alias("before")), "high")
    return out.select("chapter", "units", "tasks", (F.col("before") + F.col("place")).alias("batch"))


def lane_order(rows: DataFrame, lanes: DataFrame) -> DataFrame:
    """``rows`` with place: the lane's position, or one past the last for unknown lanes."""
    n = lanes.agg(F.max("position").alias("n"))
    return rows.join(F.broadcast(lanes.select("lane", "position")), "lane", "left").join(F.broadcast(n)).withColumn("place", F.coalesce("position", F.col("n") + 1)).drop("position", "n")


def discipline(tasks: DataFrame, records: DataFrame, outputs: DataFrame) -> DataFrame:
    """Expected pairs, recorded ones and those without output, by lane; ``outputs`` has unit_id and lane."""
    done = records.select(F.col("id").alias("task_id"), F.lit(1).alias("r")).distinct()
    there = outputs.select("unit_id", "lane", F.lit(1).alias("o")).distinct()
    df = tasks.join(done, "task_id", "left").join(there, ["unit_id", "lane"], "left")
    return df.groupBy("lane").agg(F.count("*").alias("expected"), F.count("r").alias("recorded"), F.count_if(F.col("o").isNull()).alias("missing_outputs"))


def run_manifest(tasks: DataFrame, records: DataFrame, verified: DataFrame) -> DataFrame:
    """One row a planned task: its run and what verification said; ``verified`` has unit_id, lane, valid and issues (their number).

    state is unrecorded, unverified, invalid or valid.
    """
    df = tasks.select("unit_id", "lane", "task_id").join(records.withColumnRenamed("id", "task_id"), "task_id", "left").join(verified.select("unit_id", "lane", "valid", "issues"), ["unit_id", "lane"], "left")
    state = F.when(F.col("job_id").isNull(), "unrecorded").when(F.col("valid").isNull(), "unverified").when(~F.col("valid"), "invalid").otherwise("valid")
    return df.select("unit_id", "lane", "task_id", *ALIASES, state.alias("state"), F.coalesce("issues", F.lit(0)).alias("issues"))
