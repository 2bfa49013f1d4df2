"""Control tables: ledger totals, latest states, gates and drift, fingerprints, reruns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The phases in order, and the gate states that let a run go on.
PHASES = ("1", "1.5", "2.1", "2.2", "2.3", "2.4", "3.0", "3.1", "3.2", "3.3", "3.4", "3.5", "4", "5", "post")
READY_GATES = ("PASS", "AWAITING_USER_CONFIRMATION", "STALE")
READY = ("READY_FOR_1", "READY_FOR_1.5", "READY_FOR_2", *(f"READY_FOR_{p}" for p in PHASES[2:-1]), "READY_FOR_POST", "AWAITING_USER_CONFIRMATION", "DONE", "LEGACY_FROZEN", "FAILED", "IN_PROGRESS")


def ledger_totals(events: DataFrame, phase: str, sums: list[str]) -> DataFrame:
    """Events and sums by phase, and the grand total under a null phase."""
    return events.rollup(phase).agg(F.count("*").alias("events"), *(F.sum(c).alias(c) for c in sums))


def latest(rows: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """Each key's columns in its last row, with map-side combination."""
    last = rows.groupBy(key).agg(F.max(F.struct(*order, *columns)).alias("r"))
    return last.select(key, *(F.col(f"r.{c}").alias(c) for c in columns))


def drift(recorded: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and issue where recorded and found gates differ: missing, unrecorded, or a state that is not ready."""
    r = recorded.select(*keys, F.lit(True).alias("in_state"))
    f = found.select(*keys, F.lit(True).alias("on_disk"), "status")
    both = r.join(f, keys, "full_outer")
    issue = F.when(F.col("on_disk").isNull(), "missing gate").when(F.col("in_state").isNull(), "unrecorded gate").when(~F.col("status").isin(*READY_GATES), "not ready")
    return both.select(*keys, issue.alias("issue")).filter("issue is not null")


def next_action(states: DataFrame) -> DataFrame:
    """slug, status, owner of the next step (a phase, human, blocked, none) and drift for unknown states."""
    phase = F.regexp_extract("status", r"^READY_FOR_(.+)$", 1)
    action = (
        F.when(F.col("status").isNull(), "start")
        .when(~F.col("status").isin(*READY), "drift")
        .when(phase != "", F.lower(phase))
        .when(F.col("status") == "AWAITING_USER_CONFIRMATION", "human")
        .when(F.col("status") == "FAILED", "blocked")
        .when(F.col("status") == "IN_PROGRESS", "rerun")
        .otherwise("none")
    )
    return states.select("slug", "status", action.alias("next"))


def require_gate(states: DataFrame, gates: DataFrame, phase: str, allowed: tuple[str, ...]) -> DataFrame:
    """slug and issue where a phase may not start: its gate is missing or failed, it is not completed, or the state does not allow it."""
    gate = gates.filter(F.col("phase") == phase).select("slug", F.col("status").alias("gate"))
    df = states.join(gate, "slug", "left")
    issue = F.when(F.col("gate").isNull(), "gate missing").when(F.col("gate") != "PASS", "gate not PASS").when(~F.array_contains("completed_phases", phase), "phase not complete").when(~F.col("status").isin(*allowed), "state not ready")
    return df.select("slug", issue.alias("issue")).filter("issue is not null")


# By phase, the phase whose gate it needs, and the states in which it may start.
PRECONDITIONS = {
    "2.1": ("1.5", ("READY_FOR_2.1", "READY_FOR_2", "IN_PROGRESS", "READY_FOR_2.2")),
    "2.3": ("2.2", ("READY_FOR_2.3", "READY_FOR_2.4", "IN_PROGRESS")),
    "2.4": ("2.3", ("READY_FOR_2.4", "READY_FOR_3.0", "IN_PROGRESS")),
    "3.0": ("2.4", ("READY_FOR_3.0", "READY_FOR_3.1", "IN_PROGRESS")),
    "3.1": ("3.0", ("READY_FOR_3.1", "READY_FOR_3.2", "IN_PROGRESS")),
    "3.2": ("3.1", ("READY_FOR_3.2", "READY_FOR_3.3", "IN_PROGRESS")),
    "3.3": ("3.2", ("READY_FOR_3.3", "IN_PROGRESS")),
    "3.4": ("3.3", ("READY_FOR_3.4", "IN_PROGRESS", "FAILED")),
    "3.5": ("3.4", ("READY_FOR_3.5", "IN_PROGRESS", "FAILED")),
    "4": ("3.5", ("READY_FOR_4", "IN_PROGRESS", "AWAITING_USER_CONFIRMATION")),
    "5": ("4", ("READY_FOR_5", "IN_PROGRESS", "FAILED")),
}
# The reports that a phase also wants with status PASS, and a number of theirs that must be over zero.
REPORTS = {"3.3": ("size", None), "3.4": ("dispatch", None), "3.5": ("verification", None), "4": ("presentation", None), "5": ("confirmation", "selected_count")}


def preflight(states: DataFrame, gates: DataFrame, reports: DataFrame) -> DataFrame:
    """slug, phase and issue, null where the phase may start, of every slug and phase of ``PRECONDITIONS``.

    ``states`` has slug, status and completed_phases, ``gates`` slug, phase and status, ``reports`` slug, kind, status and count.
    The first thing that is wrong counts: gate missing, gate not PASS, phase not complete, state not ready, report not PASS, report empty.
    """
    row = lambda p: F.struct(F.lit(p).alias("phase"), F.lit(PRECONDITIONS[p][0]).alias("needs"), F.array(*map(F.lit, PRECONDITIONS[p][1])).alias("allowed"), F.lit(REPORTS.get(p, (None, None))[0]).cast("string").alias("kind"), F.lit(bool(REPORTS.get(p, (None, None))[1])).alias("counted"))
    # a column for each phase and kind that counts, so that a slug's gates and reports are one row each, and its phases are told apart behind the joins
    needs, kinds = sorted({n for n, _ in PRECONDITIONS.values()}), sorted({k for k, _ in REPORTS.values()})
    gate = gates.filter(F.col("phase").isin(*needs)).groupBy("slug").agg(*(F.max(F.when(F.col("phase") == n, F.col("status"))).alias(f"gate{i}") for i, n in enumerate(needs)))
    of = lambda k, c: F.max(F.when(F.col("kind") == k, F.col(c)))
    said = reports.filter(F.col("kind").isin(*kinds)).groupBy("slug").agg(*(of(k, c).alias(f"{c}{i}") for i, k in enumerate(kinds) for c in ("status", "count")))
    said = said.select("slug", *(F.col(f"status{i}").alias(f"said{i}") for i in range(len(kinds))), *(F.col(f"count{i}").alias(f"n{i}") for i in range(len(kinds))))
    joined = states.select("slug", "status", "completed_phases").join(gate, "slug", "left").join(said, "slug", "left")
    held = lambda names, name: F.create_map(*(x for i, v in enumerate(names) for x in (F.lit(v), F.col(f"{name}{i}"))))
    maps = joined.select("slug", "status", "completed_phases", held(needs, "gate").alias("gates"), held(kinds, "said").alias("saids"), held(kinds, "n").alias("ns"), F.explode(F.array(*map(row, PRECONDITIONS))).alias("r"))
    df = maps.select("slug", "status", "completed_phases", "r.*", F.try_element_at("gates", F.col("r.needs")).alias("gate"), F.try_element_at("saids", F.col("r.kind")).alias("said"), F.try_element_at("ns", F.col("r.kind")).alias("n"))
    ready = F.array_contains("allowed", F.coalesce("status", F.lit("")))
    wanted = F.col("kind").isNotNull()
    issue = (
        F.when(F.col("gate").isNull(), "gate missing").when(F.col("gate") != "PASS", "gate not PASS").when(~F.coalesce(F.array_contains("completed_phases", F.col("needs")), F.lit(False)), "phase not complete").when(~ready, "state not ready")
        .when(wanted & ~F.col("said").eqNullSafe("PASS"), "report not PASS").when(wanted & F.col("counted") & ~F.coalesce(F.col("n") > 0, F.lit(False)), "report empty")
    )
    return df.select("slug", "phase", issue.alias("issue"))


def tree_fingerprints(files: DataFrame, key: str, name: str, content: str) -> DataFrame:
    """key, files and fingerprint: SHA-256 over each file's name, a zero byte, its SHA-256 and a line feed, by name.

    The digest is defined over a tree's whole list, which one task must hold: names and digests only, never
    contents, about 100 bytes a file, so that a tree may have tens of millions of files.
    """
    line = F.struct(F.col(name).cast("string").alias("n"), F.sha2(F.coalesce(F.col(content).cast("binary"), F.lit("").cast("binary")), 256).alias("h"))
    tree = files.groupBy(key).agg(F.array_sort(F.collect_list(line)).alias("t"), F.count("*").alias("files"))
    return tree.select(key, "files", F.sha2(F.array_join(F.transform("t", lambda x: F.concat(x["n"], F.lit("\u0000"), x["h"], F.lit("\n"))), "").cast("binary"), 256).alias("fingerprint"))


def unchanged(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """key and skip: whether a tree's fingerprint is what it was."""
    old = before.select(key, F.col("fingerprint").alias("old"))
    return now.join(old, key, "left").select(key, F.coalesce(F.col("fingerprint") == F.col("old"), F.lit(False)).alias("skip"))


def rerun(gates: DataFrame, phase: str) -> DataFrame:
    """``gates`` (slug, phase, status) with those from ``phase`` on stale and their state before as previous."""
    place = F.array_position(F.array(*map(F.lit, PHASES)), F.col("phase"))
    stale = place >= PHASES.index(phase) + 1
    return gates.select("slug", "phase", F.when(stale, "STALE").otherwise(F.col("status")).alias("status"), F.when(stale, F.col("status")).alias("previous"))


def finalize(states: DataFrame) -> DataFrame:
    """``states`` with DONE where audit and grounding pass and the run is ready for it."""
    done = F.col("audit_pass") & F.col("grounding_pass") & (F.col("status") == "READY_FOR_POST")
    return states.withColumn("status", F.when(F.coalesce(done, F.lit(False)), "DONE").otherwise(F.col("status")))


def identity_conflicts(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """Slugs that come with another content than the one they are known by."""
    return incoming.join(known.withColumnRenamed("sha256", "known"), "slug").filter("sha256 <> known").select("slug", "known", "sha256")


def prune_gates(books: DataFrame) -> DataFrame:
    """slug, allowed and reason: whether what a book was read from may go.

    ``books`` has slug, archived (sources kept apart, by number), gate (of the reading, null without), status and
    texts (extracted books, by number).
    """
    kept = F.coalesce(F.col("archived") > 0, F.lit(False))
    passed, frozen = F.coalesce(F.col("gate") == "PASS", F.lit(False)), F.coalesce(F.col("status") == "LEGACY_FROZEN", F.lit(False))
    read = F.coalesce(F.col("texts") > 0, F.lit(False))
    reason = F.when(~kept, "no archived source").when(passed, "gate passed").when(frozen & read, "frozen with extracted text").when(frozen, "frozen without extracted text").otherwise("no passed gate and not frozen")
    return books.select("slug", (kept & (passed | (frozen & read))).alias("allowed"), reason.alias("reason"))


def prunable(files: DataFrame, books: DataFrame) -> DataFrame:
    """slug, files and bytes that may go; ``files`` has slug, path and length, ``books`` is as in ``prune_gates``."""
    safe = prune_gates(books).filter("allowed").select("slug")
    return files.join(safe, "slug", "left_semi").groupBy("slug").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def restarted(artifacts: DataFrame, slug: str, confirmed: bool = False) -> DataFrame:
    """``artifacts`` (slug, ...) without those of one slug; refused unless confirmed."""
    if not confirmed:
        raise PermissionError("restarting deletes all artifacts of a slug and must be confirmed")
    return artifacts.filter(~F.col("slug").eqNullSafe(slug))


def archived(folders: DataFrame, superseded: DataFrame, root: str, phase: str = "phase-3.2") -> DataFrame:
    """unit_id, path and moved_to of the team folders of units that were split; ``folders`` has every path under ``root``.

    A name that the archive has already gets the first free number after it.
    """
    place = f"{root}/_superseded/{phase}"
    own = superseded.select("unit_id", F.concat(F.lit(f"{root}/team-"), "unit_id").alias("path")).join(folders.select("path").distinct(), "path")
    stem = F.concat(F.lit(f"{place}/team-"), "unit_id")
    taken = folders.filter(F.col("path").startswith(f"{place}/")).select(F.regexp_replace("path", r"\.\d+$", "").alias("stem"), F.coalesce(F.nullif(F.regexp_extract("path", r"\.(\d+)$", 1), F.lit("")).cast("int"), F.lit(0)).alias("k"))
    used = taken.groupBy("stem").agg(F.collect_set("k").alias("ks"))
    df = own.withColumn("stem", stem).join(used, "stem", "left")
    free = F.array_min(F.array_except(F.sequence(F.lit(0), F.size(F.coalesce("ks", F.array().cast("array<int>")))), F.coalesce("ks", F.array().cast("array<int>"))))
    return df.select("unit_id", "path", F.when(free == 0, F.col("stem")).otherwise(F.concat_ws(".", "stem", free)).alias("moved_to"))


def gate_marks(gates: DataFrame) -> DataFrame:
    """``gates`` (slug, phase, status, writer, valid, total, missing) with validation_passed and blockid_valid: what the marker files say.

    The first needs a non-empty PASS of extractions that are all valid, the second one without missing ids.
    """
    passed = F.coalesce((F.col("status") == "PASS") & (F.col("total") > 0), F.lit(False))
    whole = F.coalesce(F.col("valid") == F.col("total"), F.lit(False))
    return gates.withColumn("validation_passed", passed & whole & (F.col("phase") == "3.4")).withColumn("blockid_valid", passed & F.coalesce(F.col("missing") == 0, F.lit(False)) & (F.col("phase") == "4"))


def audit_summary(checks: DataFrame) -> DataFrame:
    """Passed, failed and manual checks by category; a manual check fails unless acknowledged, and a warning alone does not pass."""
    ok = F.coalesce(F.col("passed"), F.lit(False)) & (~F.col("manual") | F.coalesce(F.col("acknowledged"), F.lit(False)))
    return checks.groupBy("category").agg(F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed"), F.count_if("manual").alias("manual"))
