"""Operators on artifacts, tables, files, control tables, sinks and the audit, with cases made by hand."""

import json

import pytest
from pyspark.sql import functions as F

from attestry.functions import text
from attestry.operators import audit, chapters, control, ocr, tables
from attestry.sources import files, sinks


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect() if columns else df.collect()), key=str)


def test_tables_carry_spans():
    table = "<table><tr><td rowspan='2'>a</td><td colspan=2>b|c</td></tr><TR><TH>d</TH><td rowspan=\"9\">e<br>f</td></tr><tr><td>g</td><td>h</td><td>i</td></tr></table>"
    assert tables.pipe_table(table).splitlines() == ["| a   | b\\|c |     |", "| --- | ---- | --- |", "|     | d    | e f |", "| g   | h    |     |"]
    # wider than asked for: what finds no room goes; a span over the end of the table ends with it
    assert tables.pipe_table("<table><tr><td rowspan=3>a</td></tr><tr><td>b</td></tr></table>") == "| a   |\n| --- |"
    assert tables.pipe_table("<table><tr><td>&lt;x&amp;y&gt;</td><td><b>bold</b><!-- <td>no</td> --></td></tr></table>").splitlines()[0] == "| <x&y> | bold |"
    assert tables.pipe_table("<table><tr><td>" + "w" * 60 + "</td></tr><tr><td></td></tr></table>").splitlines() == [f"| {'w' * 60} |", f"| {'-' * 40} |"]
    # spans that are no numbers: rows of as many cells as the first one has
    assert tables.pipe_table("<table><tr><td>a</td><td>b</td></tr><tr><td colspan='x'>c</td></tr></table>").splitlines() == ["| a | b |", "| --- | --- |", "| c |  |"]
    for nothing in (None, "", "no table", "<table></table>", "<table><tr><td> </td></tr></table>", "<table><td>no row</td></table>"):
        assert tables.pipe_table(nothing) == ""
    wide = tables.pipe_table("<table><tr><td colspan=1000000000>a</td></tr></table>")
    assert wide.splitlines()[0].count("|") == tables.MOST_COLUMNS + 1
    assert tables.pipe_table("<table><tr><td rowspan=1000000000>a</td><td>b</td></tr><tr><td>c</td></tr></table>").splitlines()[2] == "|     | c   |"


def test_artifacts(spark):
    good, pages = {"ok": True, "text": "x"}, {"layout_details": [[{"label": "text"}]]}
    cases = {
        "list": [1], "empty list": [], "ok": good, "ok without": {"ok": True, "text": " "}, "ok pages": {"ok": True, "result": pages}, "not ok": {"ok": False, "text": "x"}, "pages": pages, "flat": {"layout_details": [{"label": "x"}]},
        "no pages": {"layout_details": [5]}, "chunks": {"chunks": [{"result": good}, {"result": {"ok": True} | pages}]}, "bad chunk": {"chunks": [{"result": good}, {"result": {"ok": False, "text": "x"}}]}, "no chunk": {"chunks": []},
        "failures": {"chunks": [{"result": good}], "failures": [1]}, "chunk without result": {"chunks": [5]}, "text": "x", "other": {"a": 1},
    }
    df = spark.createDataFrame([("s", k, json.dumps(v)) for k, v in cases.items()] + [("s", "broken", "{"), ("s", "null", None)], "slug string, path string, json string")
    assert {r.path for r in ocr.artifact_validity(df).collect() if r.valid} == {"list", "ok", "ok pages", "pages", "flat", "chunks"}
    made = [
        ("s", "r/s/glmocr_output/s/s.json", True, True, 100 + 70 + 10 + 5),
        ("s", "r/s/glmocr_output/combined.json", True, False, 180),
        ("s", "r/s/glmocr_output_old/my-combined.json", True, False, 0),
        ("s", "r/s/S.JSON", True, False, 80),
        ("s", "glmocr_output/x_model.json", True, None, 120),
        ("s", "glmocr_output/Layout.json", True, True, -10_000),
        ("s", "glmocr_output/layout.json.bak", True, False, 100),
        ("s", "r/s/glmocr_output/s.json", False, True, -10_000),
        ("t", "glmocr_output/middle.json", True, True, -10_000),
        ("u", "b/deep/u.json", True, False, 70),
        ("u", "b/u.json", True, False, 70),
    ]
    df = spark.createDataFrame([r[:4] for r in made], "slug string, path string, valid boolean, has_images boolean")
    assert {r.path: r.score for r in ocr.artifact_scores(df).collect()} == {r[1]: r[4] for r in made}
    assert rows(ocr.best_artifact(df)) == [("s", "r/s/glmocr_output/s/s.json", 185), ("u", "b/u.json", 70)]


def test_parts_leave_room_for_their_front_matter(spark):
    body = "\n".join(f"line {i}" if i % 9 else "" for i in range(1, 61))
    df = spark.createDataFrame([("ch-01-a.md", body), ("ch-02-b.md", "one\ntwo")], "file string, text string")
    parts = chapters.size_split(df, "file", 30, 5).cache()
    assert {r.file: r.n for r in parts.groupBy("file").agg(F.count("*").alias("n")).collect()} == {"ch-01-a.md": 4, "ch-02-b.md": 1}
    assert rows(parts.filter("file like '%01%'"), "line_start", "line_end") == sorted([(1, 18), (19, 36), (37, 54), (55, 60)], key=str)
    docs = spark.createDataFrame([("ch-01-a.md", 1, 'A "b"', "100-200", None, "2024-01-01", body), ("ch-02-b.md", 2, None, None, None, None, "one\ntwo")], "file string, chapter int, title string, source_lines string, page_range string, ingested string, text string")
    written = {r.file: r.text for r in chapters.part_texts(docs, parts, "demo").collect()}
    assert sorted(written) == [f"ch-01-a_part0{k}.md" for k in (1, 2, 3, 4)]
    second = written["ch-01-a_part02.md"]
    assert 'title: "A \\"b\\" (part 02)"\n' in second and 'source_lines: "118-135"\n' in second and 'phase_3_2_part: "2/4"\n' in second and 'unit_id: "ch01-part02"\n' in second
    assert "".join(t.split("---\n", 2)[2] for _, t in sorted(written.items())) == body + "\n"
    lengths = spark.createDataFrame([(t,) for t in written.values()], "t string").select(text.rendered_lines("t").alias("n"))
    assert max(r.n for r in lengths.collect()) <= 30
    with pytest.raises(ValueError):
        chapters.size_split(df, "file", 13)
    sizes = spark.createDataFrame([("ch01", 10), ("ch02", 99), ("ch03-part01", 99)], "unit_id string, line_count int")
    assert rows(chapters.oversized(sizes, 30), "unit_id", "nested") == [("ch02", False), ("ch03-part01", True)]
    units = spark.createDataFrame([("s", "b", 2, None, "ch02"), ("s", "a", 1, 2, "ch01-part02"), ("s", "c", 1, 1, "ch01-part01"), ("r", "z", 9, None, "ch09"), ("s", "d", 1, None, "ch01")], "slug string, file string, chapter_num int, part_num int, unit_id string")
    assert [r.unit_id for r in chapters.in_order(units).collect()] == ["ch09", "ch01", "ch01-part01", "ch01-part02", "ch02"]


def test_titles_and_paths(spark):
    cases = ["x\ntitle: 'T: u'\n# H", "# H one #\ntitle:", "## H two\nx", "none", "\n" * 40 + "title: late\n# H", "\n" * 60 + "# H", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string").select("i", text.unit_title("t", F.lit("f")).alias("r")).orderBy("i")
    assert [r.r for r in df.collect()] == ["T: u", "f", "H two", "f", "H", "f", "f"]
    p = spark.createDataFrame([("a\\b\\c.md", "a"), ("ab/c", "a"), ("a", "a")], "p string, d string")
    assert rows(p.select(text.vault_ref("p"), text.is_under("p", "d"))) == [("a", True), ("a/b/c", False), ("ab/c", False)]


def test_prune_restart_archive_and_marks(spark):
    books = [("a", 1, "PASS", "DONE", 0), ("b", 0, "PASS", "DONE", 1), ("c", 1, "FAIL", "LEGACY_FROZEN", 1), ("d", 1, None, "LEGACY_FROZEN", 0), ("e", 1, None, "DONE", 1), ("f", None, None, None, None)]
    df = spark.createDataFrame(books, "slug string, archived int, gate string, status string, texts int")
    assert {r.slug: r.reason for r in control.prune_gates(df).collect()} == {
        "a": "gate passed", "b": "no archived source", "c": "frozen with extracted text", "d": "frozen without extracted text", "e": "no passed gate and not frozen", "f": "no archived source",
    }
    there = spark.createDataFrame([("a", "x", 5), ("a", "y", 7), ("b", "z", 9)], "slug string, path string, length long")
    assert rows(control.prunable(there, df)) == [("a", 2, 12)]
    with pytest.raises(PermissionError):
        control.restarted(there, "a")
    assert rows(control.restarted(there, "a", True)) == [("b", "z", 9)]
    folders = ["e/team-ch01", "e/team-ch02", "e/_superseded/phase-3.2/team-ch01", "e/_superseded/phase-3.2/team-ch01.1", "e/_superseded/phase-3.2/team-ch01.3"]
    moved = control.archived(spark.createDataFrame([(f,) for f in folders], "path string"), spark.createDataFrame([("ch01",), ("ch02",), ("ch03",)], "unit_id string"), "e")
    assert rows(moved, "unit_id", "moved_to") == [("ch01", "e/_superseded/phase-3.2/team-ch01.2"), ("ch02", "e/_superseded/phase-3.2/team-ch02")]
    gates = [("s", "3.4", "PASS", 3, 3, None), ("t", "3.4", "PASS", 2, 3, None), ("s", "4", "PASS", 5, 5, 0), ("t", "4", "PASS", 5, 5, 2), ("u", "4", "FAIL", 5, 5, 0), ("u", "3.4", "PASS", 0, 0, None)]
    marks = control.gate_marks(spark.createDataFrame(gates, "slug string, phase string, status string, valid long, total long, missing long"))
    assert rows(marks.filter("validation_passed or blockid_valid"), "slug", "phase") == [("s", "3.4"), ("s", "4")]


def test_preconditions_and_identity(spark):
    states = spark.createDataFrame([("a", "READY_FOR_2", ["1"]), ("b", "READY_FOR_2", []), ("c", "ODD", ["1"]), ("d", "READY_FOR_2", ["1"]), ("e", "READY_FOR_2", ["1"])], "slug string, status string, completed_phases array<string>")
    gates = spark.createDataFrame([("a", "1", "PASS"), ("b", "1", "PASS"), ("c", "1", "PASS"), ("d", "1", "FAIL"), ("e", "2", "PASS")], "slug string, phase string, status string")
    assert rows(control.require_gate(states, gates, "1", ("READY_FOR_2",))) == [("b", "phase not complete"), ("c", "state not ready"), ("d", "gate not PASS"), ("e", "gate missing")]
    known = spark.createDataFrame([("a", "1"), ("b", "2")], "slug string, sha256 string")
    new = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4")], "slug string, sha256 string")
    assert rows(control.identity_conflicts(known, new)) == [("b", "2", "3")]


def test_rebuilt_index(spark):
    old = "# Index\n\n> Last updated: never\n\n## Other\n- [[x]]\n\n## Extracted Concepts\n- [[stale]]\n> Last updated: keep\n\n## Last\nend\n"
    stems = spark.createDataFrame([("b",), ("a",), ("a",)], "stem string")
    index = lambda *t: spark.createDataFrame([(x,) for x in t], "text string")
    assert sinks.rebuilt_index(index(old), stems, "2024-05-06").first().markdown == "# Index\n\n> Last updated: 2024-05-06 | 2 concept pages\n\n## Other\n- [[x]]\n\n## Extracted Concepts\n- [[a]]\n- [[b]]\n## Last\nend\n"
    assert sinks.rebuilt_index(index("# I\n"), stems, "d").first().markdown == "# I\n\n## Extracted Concepts\n- [[a]]\n- [[b]]\n"
    assert sinks.rebuilt_index(index(), stems, "d").first().markdown.endswith("> Last updated: d | 2 concept pages\n\n## Extracted Concepts\n- [[a]]\n- [[b]]\n")
    assert rows(sinks.index_with(spark.createDataFrame([("a",), ("z",)], "stem string"), stems)) == [("a",), ("b",), ("z",)]


def test_sinks_and_fronts(spark, tmp_path):
    gates = [("s", "1", "FAIL", 1), ("s", "1", "PASS", 2), ("s", "2", "PASS", 1)]
    for part in (gates[:2], gates[2:]):
        sinks.append_gate(spark.createDataFrame(part, "slug string, phase string, status string, at int"), str(tmp_path / "gates"))
    assert rows(sinks.latest_gates(spark.read.parquet(str(tmp_path / "gates")))) == [("s", "1", "PASS", 2), ("s", "2", "PASS", 1)]
    made = spark.createDataFrame([("s", "ch-01-a.md", 1, 'T "q"', "1-9", "body")], "slug string, file string, chapter int, title string, source_lines string, text string")
    sinks.write_chapters(made, str(tmp_path / "chapters"))
    with pytest.raises(Exception, match="exist"):
        sinks.write_chapters(made, str(tmp_path / "chapters"))
    sinks.write_chapters(made, str(tmp_path / "chapters"), force=True)
    (written,) = (tmp_path / "chapters/slug=s/file=ch-01-a.md").glob("*.txt")
    assert written.read_text() == '---\nsource: "[[s]]"\nchapter: 1\ntitle: "T \\"q\\""\nsource_lines: "1-9"\n---\n\nbody\n'
    sinks.write_json(spark.createDataFrame([(None, 1)], "b string, a int"), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"a":1,"b":null}'
    listed = [("s", "schema", "a.json"), ("s", "schema", "_b.json"), ("s", "", "c.json"), ("t", "", "c.json"), ("t", "", "master-x.json"), ("t", "", "x-report.json"), ("t", "", "dispatch-result.json"), ("t", "gates", "g.json")]
    assert rows(files.audited_extractions(spark.createDataFrame(listed, "slug string, folder string, file string")), "slug", "file") == [("s", "a.json"), ("t", "c.json")]
    agents = spark.createDataFrame([("a", "---\nname: 'x'\n# no: c\n  nested: d\nname: y\nurl: http://z\n---\nbody"), ("b", "no front")], "k string, text string")
    assert {r.k: r.fields for r in files.agent_front_matter(agents, ["k"]).collect()} == {"a": {"name": "y", "url": "http://z"}, "b": {}}
    answers = spark.createDataFrame([("a", "```markdown\n---\nt: 1\n---\n# B\n```"), ("b", "# only"), ("c", None)], "k string, text string")
    assert rows(files.agent_output(answers, ["k"])) == [("a", "t: 1", "# B"), ("b", "", "# only"), ("c", "", "")]
    noise = spark.createDataFrame([('log {x} {"a": 1}', "x\n<!-- source_index_json\n{\"a\": [1]}\n-->")], "n string, e string")
    assert noise.select(files.after_noise("n"), files.embedded_index("e")).first()[:] == ('{x} {"a": 1}', '{"a": [1]}')


def test_audit(spark):
    front = "---\n" + "".join(f'{k}: "x"\n' if k == "title" else f"{k}: 0.5\n" for k in ("title", "created", "updated", "confidence", "last_reinforced", "tier", "quality", "quality_notes", "scope", "author")) + "---\n"
    good = front + "## Author's Words\n" + "> a quote of the author ![[raw/c#^demo-ch01-0001]]\n" * 2 + "## Specific Example\nsee ^demo-ch01-0001\n## Relations\n- extracted_from::[[raw/c#^demo-ch01-0001]]\n" + "text\n" * 80
    bad = "---\ntitle: a: b\nconfidence: 0.99\n---\nderived_from::demo ![[raw/c#^demo-ch01-0009]]"
    pages = spark.createDataFrame([("good.md", good), ("goods.md", good), ("bad.md", bad)], "page string, text string")
    vault = spark.createDataFrame([("raw/c.md", "x ^demo-ch01-0001")], "file string, text string")
    index = spark.createDataFrame([("[[good]] [[bad]] [[goods|g]] [[old]] [[gone]]",)], "text string")
    archive = spark.createDataFrame([("old",)], "stem string")
    found = audit.page_checks(pages, "demo")
    assert {r.check_id for r in found.collect() if r.subject == "bad.md"} == {"SC-21", "PQ-23", "PQ-24", "PQ-28", "PQ-36", "PQ-37", "PQ-39", "PO-46", "WI-50"} and found.count() == 9
    whole = audit.vault_checks(pages, vault, index, archive)
    assert rows(whole) == [("WI-47", "bad.md anchor_missing: ![[raw/c#^demo-ch01-0009]]"), ("WI-48", "good"), ("WI-49", "goods")]
    assert rows(audit.stale_entries(pages, index, archive)) == [("gone",)]
    paths = [("b/manifest.json",), ("b/test-run/x.json",), ("b/archive/test/x",), ("b/pdf_chunks/x",), ("b/in/chunk-1/y",), ("b/test.md",)]
    listing = spark.createDataFrame(paths, "path string")
    assert rows(audit.listing_checks(listing, "b", "contract.md")) == [("CH-04", "in/chunk-1"), ("CH-04", "test-run"), ("PQ-38", "contract.md")]
    made = [("a", {"concepts": [{"block_id": "x", "confidence": 1}]}), ("b", {"concepts": [{"slug": "s"}]}), ("c", {"no_lane_content": True}), ("d", [{"block_ids": ["x"]}]), ("e", {"entities": {"k": {"block_ids": []}}})]
    extractions = spark.createDataFrame([(k, json.dumps(v)) for k, v in made] + [("f", "{")], "file string, json string")
    assert rows(audit.extraction_checks(extractions)) == [("EX-11", "b"), ("EX-11", "e"), ("EX-12", "b")]
    assert rows(audit.chapter_checks(spark.createDataFrame([("a", "x ^demo-ch01-0001"), ("b", "^demos-ch01-0001"), ("c", None)], "file string, text string"), "demo")) == [("CH-02", "b"), ("CH-02", "c")]
    reports = {
        "specialist-dispatch-report.json": {"agent_mode": audit.AGENT_MODE}, "schema-validation-report.json": {"status": "PASS", "valid": 3, "total": 3}, "phase4-scoring-report.json": {"status": "PASS", "candidate_count": 2}, "master-scored.json": {},
        "phase4-confirmation.json": {"status": "PASS", "selected_count": 1}, "gates/phase-4.json": {"status": "PASS"}, "gates/phase-5.json": {"status": "PASS"}, "blockid-validation-report.json": {"valid": True, "referenced_block_ids": 4, "missing_count": 0},
        "master-top-clean.json": {"_latex_filtered": {}}, "page-build-report.json": {"generated_by": "pager", "status": "PASS", "pages_written": 1}, "presentation-report.json": {"status": "PASS", "checked": 1},
    }
    writers = {"pages": "pager", "schema": "schemer", "blocks": "blocker"}
    marks = spark.createDataFrame([("_validation_passed", f"validated_by: schemer"), ("_blockid_valid", f"validated_by: blocker")], "name string, text string")
    table = lambda d: spark.createDataFrame([(k, json.dumps(v)) for k, v in d.items()], "name string, json string")
    assert audit.report_checks(table(reports), marks, writers).count() == 0
    worse = reports | {"schema-validation-report.json": {"status": "PASS", "valid": 2, "total": 3}, "blockid-validation-report.json": {"valid": True, "referenced_block_ids": 4, "missing_count": 1}}
    assert {r.check_id for r in audit.report_checks(table(worse), marks, writers).collect()} == {"EX-10", "SC-18"}
    assert {r.check_id for r in audit.report_checks(table({}), marks.limit(0), writers).collect()} == {"EX-08", "EX-10", "SC-15", "SC-16", "SC-17", "SC-18", "SC-19", "SC-20", "PO-45"}
    log = spark.createDataFrame([("## [2024] split | demo | x",), ("Regex fallback used",)], "line string")
    assert rows(audit.log_checks(log, "demo")) == [("EX-14", "log")]
    every = audit.report(found.union(whole), ("PQ-27",), {"PO-42": True})
    got = {r.check_id: r for r in every.collect()}
    assert len(got) == 44 and not got["WI-48"].passed and got["WI-48"].examples == ["good"] and got["CH-02"].passed and got["PO-42"].passed and not got["SC-22"].passed
    sums = {r.category: (r.passed, r.failed, r.manual) for r in control.audit_summary(every).collect()}
    assert sums["Wiki Integrity"] == (1, 4, 0) and sums["Phase 1-2"] == (3, 1, 1)


def test_preflight_tells_phases_apart_behind_its_joins(spark):
    states = spark.createDataFrame([("a", "READY_FOR_5", ["4"]), ("b", "READY_FOR_5", ["4"]), ("b", "FAILED", None)], "slug string, status string, completed_phases array<string>")
    gates = spark.createDataFrame([("a", "4", "PASS"), ("a", None, "FAIL"), ("a", "other", "FAIL"), ("b", "4", "PASS"), (None, "4", "FAIL")], "slug string, phase string, status string")
    reports = spark.createDataFrame([("a", "confirmation", "PASS", 2), ("a", "other", "FAIL", 0), ("b", "confirmation", "PASS", None)], "slug string, kind string, status string, count int")
    found = control.preflight(states, gates, reports)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")
    assert sorted((r.slug, r.issue or "") for r in found.filter("phase = '5'").collect()) == [("a", ""), ("b", "phase not complete"), ("b", "report empty")]
