"""The layouts of the five reports, and the preconditions of phases."""

from pyspark.sql import functions as F

from attestry.operators import control, reports


def _text(lines):
    return reports.markdown(lines).first().markdown


def test_overlap_report(spark):
    rows = spark.createDataFrame([("b", "LOW_OVERLAP", 2, 0.05, 0.2), ("a|x", "PASS", 1, 0.5, 0.25)], "page string, status string, cited long, synthesis_overlap double, full_overlap double")
    text = _text(reports.overlap(rows, "s"))
    assert text.splitlines()[:5] == ["# Lexical Overlap Report — `s`", "", "Threshold: synthesis overlap ≥ `0.12`", "Pages checked: 2", "Flagged pages: 1"]
    assert text.endswith("|---|---|---:|---:|---:|\n| PASS | `a\\|x` | 1 | 0.5000 | 0.2500 |\n| LOW_OVERLAP | `b` | 2 | 0.0500 | 0.2000 |\n")
    assert "Pages checked: 0" in _text(reports.overlap(rows.limit(0), "s"))


def test_image_report(spark):
    rows = spark.createDataFrame([("i.png", 3, ["p"], ["a", "b", "c", "d", "e", "f"]), ("j.png", 1, [], [])], "image string, refs long, concept_pages array<string>, team_pages array<string>")
    refs = spark.createDataFrame([(2, 5, 4, None, "PASS")], "chapter_files long, local_refs long, resolved long, missing long, status string")
    text = _text(reports.image_coverage(rows, refs, "s"))
    assert "- Resolved: `4`\n- Missing: `unknown`\n- Status: `PASS`\n" in text and "Images referenced by concept pages: `1`\n" in text
    assert "| `i.png` | 3 | `p` | `a`, `b`, `c`, `d`, … +2 |\n| `j.png` | 1 | — | — |\n" in text


def test_balance_report(spark):
    metrics = spark.createDataFrame([("u2", "formulas", 3, 2, 1, 0.75, 0.6), ("u2", "notes", 1, 1, 0, 0.25, 0.2), ("u2", "evidence_index", 1, 1, 0, 0.0, 0.2), ("u1", "notes", 0, 0, 0, 0.0, 0.0)], "unit_id string, category string, citations long, unique long, embeds long, share_body double, share_total double")
    findings = spark.createDataFrame([("u1", "warning", "thin_citations", "notes", "too few")], "unit_id string, severity string, code string, category string, message string")
    text = _text(reports.balance(metrics, findings, "s"))
    assert "status: WARNING\nunit_count: 2\nwarning_count: 1\n" in text and text.index("Unit `u1`") < text.index("Unit `u2`")
    assert "- **warning / thin_citations / notes** — too few\n" in text
    assert "- dominant_body_category: formulas (75%)\n" in text and "| formulas | 3 | 2 | 1 | 75% | 60% |\n| notes | 1 | 1 | 0 | 25% | 20% |\n\n### Findings\n\n- none\n" in text


def test_candidate_and_rationale_reports(spark):
    clean = spark.createDataFrame([(2, "b", 9, 1, 0.5, 2), (1, "a", 12, 3, 0.95, 7)], "rank long, slug string, score long, chapters long, confidence double, blocks long")
    scored = spark.createDataFrame([("z", 3, 0), ("a", 12, 7)], "slug string, score long, blocks long")
    flags = spark.createDataFrame([(["a", "b"], None, "alike"), (["a"], ["as"], "same form")], "slugs array<string>, existing array<string>, reason string")
    text = _text(reports.candidates(clean, scored, scored.select("slug").limit(0), flags, "s"))
    assert "candidate_count: 2\ntotal_scored_concepts: 2\n" in text and "- in-batch: `a` vs `b` — alike\n- vs-existing: `a` vs existing page(s) `as` — same form\n" in text
    assert "| 1 | `a` | 12 | 3 | 0.95 | 7 |\n| 2 | `b` | 9 | 1 | 0.50 | 2 |\n\n## LaTeX/artifact slugs removed\n\n- none\n" in text and text.endswith("- `a` — score 12 — blocks 7\n- `z` — score 3 — blocks 0\n")
    assert "Possible duplicates" not in _text(reports.candidates(clean, scored, scored.select("slug"), flags.limit(0), "s"))
    rows = spark.createDataFrame([(1, "candidate", "a", 12, ["x", "y"], [], None, ["r|s"], "good\nreason")], "rank long, status string, slug string, score long, lanes array<string>, blocks array<string>, sections array<string>, risks array<string>, reason string")
    claims = spark.createDataFrame([(2, "x", "b1", "t", "EXTRACTED", "AMBIGUOUS", "lost"), (1, "y", "b2", "u", "AMBIGUOUS", "AMBIGUOUS", "")], "ord long, lane string, block_id string, text string, confidence string, effective_confidence string, reason string")
    text = _text(reports.rationale(rows, claims, "s"))
    assert "| 1 | candidate | `a` | 12 | x, y | none | none | r\\|s | good reason |\n" in text
    assert text.endswith("- `y` claim at `^b2`: u (AMBIGUOUS → AMBIGUOUS)\n- `x` claim at `^b1`: t (EXTRACTED → AMBIGUOUS) — lost\n")
    assert _text(reports.rationale(rows.limit(0), claims.limit(0), "s")).endswith("- none\n")


def test_preflight_names_the_first_thing_that_is_wrong(spark):
    done = [p for p in control.PHASES if p != "2.3"]
    states = spark.createDataFrame([("a", "IN_PROGRESS", list(control.PHASES)), ("b", "READY_FOR_5", done), ("c", None, None)], "slug string, status string, completed_phases array<string>")
    gates = spark.createDataFrame([("a", p, "PASS") for p in control.PHASES if p != "3.0"] + [("b", p, "FAIL" if p == "2.2" else "PASS") for p in control.PHASES], "slug string, phase string, status string")
    reports_ = spark.createDataFrame([("a", "size", "PASS", None), ("a", "dispatch", "FAIL", 3), ("a", "confirmation", "PASS", 0), ("b", "confirmation", "PASS", 2)], "slug string, kind string, status string, count long")
    got = {(r.slug, r.phase): r.issue for r in control.preflight(states, gates, reports_).collect()}
    assert len(got) == 3 * len(control.PRECONDITIONS)
    assert got["a", "2.1"] is None and got["a", "3.1"] == "gate missing" and got["a", "3.3"] is None and got["a", "3.4"] == "report not PASS" and got["a", "5"] == "report empty"
    assert got["b", "2.3"] == "gate not PASS" and got["b", "2.4"] == "phase not complete" and got["b", "3.1"] == "state not ready" and got["b", "5"] is None
    assert {v for (s, _), v in got.items() if s == "c"} == {"gate missing"}
    assert control.preflight(states.limit(0), gates, reports_).filter(F.col("issue").isNotNull()).count() == 0
