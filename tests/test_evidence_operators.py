"""Operators on annotations, balance, claims, quotes, edges, coverage, lane outputs and selections, with cases made by hand."""

import pytest
from pyspark.sql import functions as F

from attestry.functions import text
from attestry.operators import blocks, concepts, dispatch, grounding, images, links, pages, validate


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect() if columns else df.collect()), key=str)


def test_annotation_issues(spark):
    files = [
        ("s", 1, "a.md", "# H\none ^s-ch01-0001\ntwo ^s-ch01-0002 ^t-ch01-0003\n"),
        ("s", 1, "b.md", "three ^s-ch02-0001\nfour ^s-ch01-0002\nfive ^s-ch01-7 ^s-x-ch01-0001"),
        ("s", None, "c.md", "six ^s-ch09-0001"),
        ("s", 3, "d.md", "no ids at all"),
        ("s", 3, "e.md", "# heading only"),
        ("s", 3, "f.md", None),
    ]
    out = blocks.annotation_issues(spark.createDataFrame(files, "slug string, chapter int, file string, text string"))
    assert rows(out, "file", "line_no", "block_id", "issue") == sorted(
        [
            ("a.md", 3, "t-ch01-0003", "another slug or form"),
            ("b.md", 3, "s-ch01-7", "another slug or form"),
            ("b.md", 3, "s-x-ch01-0001", "another slug or form"),
            ("b.md", 1, "s-ch02-0001", "another chapter"),
            (None, None, "s-ch01-0002", "repeated"),
            ("d.md", None, None, "no block ids"),
        ],
        key=str,
    )


def test_balance(spark):
    cite = lambda *ks: " ".join(f"^d-ch01-000{k}" for k in ks)
    bodies = [
        ("u", "Author's Words", f"> q {cite(1, 2)}\n\n![[c#^d-ch01-0001]] x"),
        ("u", "Rich Definitions", cite(1)),
        ("u", "Specific Example", cite(3)),
        ("u", "Implementation Details", cite(3, 4)),
        ("u", "Unit evidence corpus", cite(*range(1, 9)) + "\n" + cite(*range(1, 9))),
        ("u", "Other", cite(9)),
        ("v", "Relations", None),
    ]
    m = blocks.balance_metrics(spark.createDataFrame(bodies, "unit_id string, header string, body string")).cache()
    got = {(r.unit_id, r.category): r for r in m.collect()}
    assert len(got) == 18
    words, examples, index = got["u", "author_words"], got["u", "examples"], got["u", "evidence_index"]
    assert (words.citations, words.unique, words.embeds, words["lines"], words.required) == (3, 2, 1, 2, True)
    assert (examples.citations, examples.unique, examples.share_body, examples.share_total) == (3, 2, round(3 / 7, 4), round(3 / 23, 4))
    assert (index.share_body, index.share_total) == (0.0, round(16 / 23, 4)) and got["v", "formulas"].citations == 0
    found = set(rows(blocks.balance_findings(m).filter("unit_id = 'u'"), "code", "category"))
    assert ("citation_monopoly_with_thin_sections", "author_words") in found and ("evidence_index_dominates_total_citations", "evidence_index") in found
    assert {c for k, c in found if k == "thin_citations"} == {"definition", "formulas", "limitations", "relations"}


def test_balance_keeps_its_parts_as_more_sections_come(spark, monkeypatch):
    """Sections are dealt out once by unit, in parts of a fixed size that nothing puts together again; sections of no unit count nothing."""
    monkeypatch.setattr(blocks, "DEALT", 10, raising=False)
    sections = spark.range(0, 200).selectExpr("if(id = 7, null, id % 40) as unit_id", "element_at(array('Relations', 'Rich Definitions', 'Other'), cast(id % 3 + 1 as int)) as header", "concat('^d-ch01-', 1000 + id) as body")
    m = blocks.balance_metrics(sections)
    assert m.rdd.getNumPartitions() == 20
    got = {(r.unit_id, r.category): r.citations for r in m.collect()}
    assert len(got) == 41 * 9 and sum(got.values()) == sum(1 for i in range(200) if i % 3 < 2 and i != 7)
    assert all(got[u, "relations"] == sum(1 for i in range(u, 200, 40) if i % 3 == 0 and i != 7) for u in range(40))
    found = blocks.balance_findings(m)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_blocks_are_judged_and_cut_before_they_move(spark):
    """A source index shows a block's start: its whole text stays where the file was read, and ids, places and categories are those of ``annotate``."""
    texts = ["# H\n\nword " * 3 + "x" * 500, "A fee is defined as the price of a service.\n\n| a | b |\n| c | d |\n\nplain", "one ^s-ch01-0007\n\ntwo   spaces", None, ""]
    files = spark.createDataFrame([("s", i // 2 + 1, f"f{i}", t) for i, t in enumerate(texts)], "slug string, chapter int, file string, text string")
    at = ["slug", "chapter", "file", "line_no", "block_id", "category"]
    own = blocks.shown_blocks(files, lambda t: F.substring(t, 1, 60))
    want = blocks.classify(blocks.annotate(files)).withColumn("text", F.substring("text", 1, 60))
    assert rows(own, *at, "text") == rows(want, *at, "text") and own.count() == want.count() > 4
    plan = own._jdf.queryExecution().optimizedPlan().toString()
    moved, stays = plan.split("Window", 1)
    assert "substring" not in moved and "substring" in stays


def test_index_issues_and_written_indexes(spark):
    index = spark.createDataFrame([("u", "b1", "Definitions"), ("u", "b1", "Definitions"), ("u", "b2", "Odd"), ("w", "b9", "Formulas")], "unit_id string, block_id string, category string")
    chapter = spark.createDataFrame([("u", "b1"), ("u", "b2"), ("u", "b3")], "unit_id string, block_id string")
    assert rows(blocks.index_issues(index, chapter)) == sorted([("u", "b3", "missing from the index"), ("u", "b1", "extra in the index"), ("w", "b9", "extra in the index"), ("u", "b2", "unknown category"), ("w", None, "unknown unit")], key=str)
    written = spark.createDataFrame([("u", '# T\n- [d-ch01-0001] — "He said "so""\n- [d-ch01-0002] — ""'), ("v", "see d-ch01-0003, xd-ch01-0004y"), ("w", None)], "unit_id string, text string")
    assert rows(blocks.indexed_blocks(written)) == [("u", 0, "d-ch01-0001", 'He said "so'), ("u", 1, "d-ch01-0002", ""), ("v", 0, "d-ch01-0003", "d-ch01-0003")] or rows(blocks.indexed_blocks(written))[0][3].startswith("He said")


def test_overlap_is_judged_by_own_words(spark):
    quoted = "---\ntitle: winnowing\n---\n> winnowing selects minimal hashes\n- extracted_from::[[c]] selects\n- `code` minimal\nentirely different prose ![[c#^x]] follows"
    plain = "winnowing selects minimal hashes"
    page = spark.createDataFrame([("quotes", quoted), ("own", plain), ("lost", plain), ("bare", plain), ("none", None)], "page string, text string")
    cited = spark.createDataFrame([("quotes", plain), ("own", plain), ("lost", plain), ("lost", None)], "page string, text string")
    got = {r.page: (r.full_overlap > 0.12, r.synthesis_overlap, r.status) for r in grounding.lexical_overlap(page, cited).collect()}
    assert got["quotes"] == (True, 0.0, "LOW_OVERLAP") and got["own"] == (True, 1.0, "PASS") and got["lost"] == (True, 1.0, "MISSING_BLOCK")
    assert got["bare"] == got["none"] == (False, 0.0, "LOW_OVERLAP")


def test_quotes_of_all_lengths_equal_search(spark):
    import random

    rng = random.Random(5)
    words = ["ab", "abc", "b", "bc", "cab", "xyzab", "é"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 25)))) for i in range(60)] + [(99, None)]
    quotes = []
    for i in range(60):
        body = rng.choice(docs[:60])[1]
        a = rng.randint(0, len(body))
        quotes.append((i, body[a : a + rng.choice([1, 2, 3, 5, 8, 13, 30])].strip()))
    quotes += [(90, ""), (91, "absent quote"), (92, None), (93, "*ab*  `abc`")]
    want = {(q, d) for q, t in quotes for d, body in docs for n in [" ".join((t or "").replace("*", "").replace("`", "").split())] if n and n in (body or "")}
    kinds = "long, text string"
    got = grounding.quotes_in_texts(spark.createDataFrame(quotes, f"item_id {kinds}"), spark.createDataFrame(docs, f"doc_id {kinds}"))
    assert {tuple(r) for r in got.collect()} == want and len(want) > 200
    assert grounding.quotes_in_texts(spark.createDataFrame([(1, "")], f"item_id {kinds}"), spark.createDataFrame(docs, f"doc_id {kinds}")).collect() == []


def test_claims(spark):
    made = spark.createDataFrame([("f", "b1", "EXTRACTED", "the quote"), ("f", "b1", "EXTRACTED", "not there"), ("g", "b2", "INFERRED", None), ("g", "b9", "AMBIGUOUS", "")], "file string, block_id string, confidence string, quote_verbatim string")
    grounded = grounding.ground_claims(made, spark.createDataFrame([("b1", "here is the quote")], "block_id string, text string"))
    assert rows(grounding.grounding_totals(grounded)) == [(4, 2, 1, 1, 2, 0.5)]
    cited = spark.createDataFrame([("f", "one", ["b1", "b1", None]), ("g", "one", ["b1"]), ("g", "two", ["b2", "b9"])], "file string, slug string, block_ids array<string>")
    assert rows(concepts.attached_claims(cited, made), "slug", "file", "block_id") == [("one", "f", "b1"), ("one", "f", "b1"), ("two", "g", "b2"), ("two", "g", "b9")]
    index = spark.createDataFrame([("s", "u", "b1", "x"), ("s", "u", "b1", "y"), ("s", "v", "b2", "z"), ("t", "u", "b3", "w")], "slug string, unit_id string, block_id string, text string")
    assert rows(grounding.texts_by_unit(index, "s", "u")) == [("b1", "x")]
    checked = spark.createDataFrame([("f", 1, "AMBIGUOUS", "lost"), ("f", 2, "EXTRACTED", "")], "file string, claim_index int, effective_confidence string, reason string")
    claims = spark.createDataFrame([("f", 1, "EXTRACTED"), ("f", 2, "EXTRACTED"), ("g", 1, "AMBIGUOUS"), ("g", 2, None)], "file string, claim_index int, confidence string")
    assert rows(grounding.claims_for_human_eyes(claims, checked), "file", "claim_index", "reason") == [("f", 1, "lost"), ("g", 1, "")]
    citations = spark.createDataFrame([("u", "s-ch01-0001"), ("u", "s-ch01-0002"), ("u", "t-ch01-0001")], "unit_id string, block_id string")
    own = spark.createDataFrame([("u", "s-ch01-0001"), ("v", "s-ch01-0002")], "unit_id string, block_id string")
    assert rows(grounding.citation_issues(citations, own, "s")) == [("u", "s-ch01-0002", "outside unit source index"), ("u", "t-ch01-0001", "wrong slug")]


def test_edges_and_notes(spark):
    kinds = "slug string, source string, block_ids array<string>, formula_ids array<string>, warning_ids array<string>"
    made = spark.createDataFrame([("c", "src", ["b2", "b1", "b2"], ["f1", "f2", "f3", "f4"], ["w1"]), ("d", "src", [], None, None)], kinds)
    refs = spark.createDataFrame([("b1", "raw/ch-01")], "block_id string, ref string")
    edges = links.typed_edges(made, refs).cache()
    assert rows(edges, "predicate", "block_id", "target") == sorted(
        [("extracted_from", "b2", "src"), ("extracted_from", "b1", "raw/ch-01"), ("defined_by", "b2", "src"), ("warned_by", "w1", "src"), *(("formulated_by", f"f{k}", "src") for k in (1, 2, 3))], key=str
    )
    line = links.relation_lines(spark.createDataFrame([("warned_by", "a-ch01-0002", "raw/x")], "predicate string, block_id string, target string")).first().line
    assert line == "- warned_by::[[raw/x#^a-ch01-0002|^ch01-0002]]"
    claims = spark.createDataFrame([("c", "src", 1, "So it is.", "b1", "INFERRED"), ("c", "src", 2, "x", "", "INFERRED"), ("c", "src", 3, "x", "b1", "EXTRACTED")], "slug string, source string, ord int, text string, block_id string, confidence string")
    assert [r.note for r in links.inferred_claims(claims, refs).collect()] == ["⚠ **Inferred claim:** So it is. (interpretation of ![[raw/ch-01#^b1]])"]


def test_vocabulary_audit(spark):
    files = [("a.md", "- extracted_from::[[raw/b#^x]]\n- odd_one::[[b]]\n[[ghost]] ![[b.md]]"), ("raw/b.md", "- extracted_from::[[b]] [[ghost|g]]"), (".hid/c.md", "")]
    df = spark.createDataFrame(files, "file string, text string")
    assert rows(links.incoming_edges(df)) == [("b", 3)]
    assert rows(links.ghost_links(df)) == [("ghost", 2)]
    assert rows(links.foreign_predicates(df, ("extracted_from",)), "predicate", "edges") == [("odd_one", 1)]
    assert rows(links.predicate_counts(df)) == [("extracted_from", 2, 2), ("odd_one", 1, 1)]


def test_image_coverage_by_kind(spark):
    shown = spark.createDataFrame([("imgs/a.png",), ("b.jpg",), ("c.png",)], "image string")
    said = [("p", "concept", "![x](../imgs/a.png) and a.png"), ("q", "team", "see `b.jpg`, (a.png)"), ("r", "team", "xa.png c.pngx"), ("s", "team", None)]
    got = images.coverage(shown, spark.createDataFrame(said, "page string, kind string, text string")).cache()
    assert rows(got, "image", "concept_pages", "team_pages", "concept_covered", "team_covered") == [("b.jpg", 0, 1, False, True), ("c.png", 0, 0, False, False), ("imgs/a.png", 1, 1, True, True)]
    assert rows(images.coverage_totals(got)) == [(3, 1, 2)]


def test_markers_and_their_sections(spark):
    log = "### u-L0003-VISION_TABLE-1\n- status: done\n- description: a: b\ncontent: c\n- confidence: 1\n- source: s\ntype: t\n### other\nstatus: done"
    sections = images.marker_sections(spark.createDataFrame([("u", log), ("v", None)], "unit_id string, text string"))
    got = {r.id: r.fields for r in sections.collect()}
    assert got["u-L0003-VISION_TABLE-1"]["description"] == "a: b" and got["other"] == {"status": "done"}
    marks = spark.createDataFrame([("u-L0003-VISION_TABLE-1",), ("other",), ("none",)], "id string")
    assert rows(images.vision_gate(marks, sections)) == [("none", False), ("other", False), ("u-L0003-VISION_TABLE-1", True)]


def test_ids_at_any_depth(spark):
    deep = '{"block_id": "deep"}'
    for _ in range(40):
        deep = '{"a": [%s]}' % deep
    odd = r'{"x": "\"block_id\":\"no\"", "block_id": null, "y": [{"block_id": "a\"b"}, {"block_ids": ["c", 5, "d]"]}], "my_block_id": "no", "block_ids": [], "z": {"block_id": 7}}'
    df = spark.createDataFrame([("deep", deep), ("odd", odd), ("bad", "{"), ("none", None)], "file string, json string")
    assert rows(validate.recursive_block_ids(df)) == sorted([("deep", "deep"), ("odd", 'a"b'), ("odd", "c"), ("odd", "5"), ("odd", "d]"), ("odd", "7")], key=str)


def test_lane_outputs(spark):
    import json

    from attestry.plans.document_queries import _CONCEPT, _GOOD

    long = dict(_CONCEPT["definitions"][0], definition="A definition that is long enough to be of this very book")
    good = _GOOD | {"concepts": [_CONCEPT | {"definitions": [long]}]}
    outs = [
        ("demo", "u", 1, "ok", json.dumps(good)),
        ("demo", "u", 2, "chapter", json.dumps(good)),
        ("other", "u", 1, "slug", json.dumps(good)),
        ("demo", "v", 1, "scope", json.dumps(good)),
        ("demo", "u", 1, "short", json.dumps(_GOOD | {"concepts": [_CONCEPT | {"definitions": [long | {"definition": "x" * 29}]}]})),
        ("demo", "u", 1, "uncited", json.dumps(_GOOD | {"concepts": [{"slug": "a-concept", "name": "A concept"}], "claims": []})),
        ("demo", "u", 1, "declared", json.dumps(_GOOD | {"concepts": [], "claims": [], "no_lane_content": True})),
        ("demo", "u", 1, "missing", None),
        ("demo", "u", 1, "empty", ""),
        ("demo", "u", 1, "broken", "{"),
    ]
    index = spark.createDataFrame([("demo", "u", "demo-ch01-0001", "t"), ("demo", "u", "demo-ch01-0002", "t")], "slug string, unit_id string, block_id string, text string")
    found = validate.lane_schema_issues(spark.createDataFrame(outs, "slug string, unit_id string, chapter_num int, lane string, json string"), index)
    got = {}
    for r in found.collect():
        got.setdefault(r.lane, set()).add(r.issue)
    assert got == {
        "chapter": {"chapter mismatch: 1"},
        "slug": {"source mismatch: demo", "wrong slug: demo-ch01-0001", "wrong slug: demo-ch01-0002", "block id not of this slug: demo-ch01-0001", "block id not of this slug: demo-ch01-0002"},
        "scope": {"outside the unit's index: demo-ch01-0001", "outside the unit's index: demo-ch01-0002"},
        "short": {"definition too short: a-concept"},
        "uncited": {"no block ids cited"},
        "missing": {"missing schema output"},
        "empty": {"empty schema output"},
        "broken": {"invalid JSON"},
    }
    reports = spark.createDataFrame([("u", "a", "j", "r", "t"), ("u", "b", " ", None, "t"), ("u", "x", "j", "r", "t")], "unit_id string, lane string, job_id string, runtime_task_id string, runtime string")
    tasks = spark.createDataFrame([("u", "a"), ("u", "b"), ("u", "c")], "unit_id string, lane string")
    assert rows(validate.report_issues(reports, tasks)) == sorted([("u", "c", "missing"), ("u", "x", "extra"), ("u", "b", "no job_id"), ("u", "b", "no runtime_task_id")], key=str)


def test_sources_of_concepts(spark):
    made = spark.createDataFrame([("law", ["law", "laws"]), ("box", None)], "slug string, merged_slugs array<string>")
    said = spark.createDataFrame([("1-defs.json", "defs", "laws", 1, "One", ["b2", "b1", "b2", "", None]), ("2-math.json", "math", "law", 2, "Two", None), ("2-math.json", "math", "none", 2, "Two", ["b"])], "file string, lane string, slug string, chapter int, chapter_title string, block_ids array<string>")
    got = {(r.slug, r.file): r.block_ids for r in concepts.concept_sources(made, said).collect()}
    assert got == {("law", "1-defs.json"): ["b1", "b2"], ("law", "2-math.json"): []}


def test_selection_refuses_near_duplicates(spark):
    chosen = spark.createDataFrame([("red-box",), ("red-boxes",), ("blue-dot",), ("blue-dot",), ("{x}",)], "slug string")
    flagged = concepts.near_duplicates(chosen.select("slug"))
    known = spark.createDataFrame([("red-box",), ("red-boxes",), ("{x}",)], "slug string")
    got = rows(concepts.selection_issues(chosen, known, flagged))
    assert got == sorted([("red-box", "near duplicate of red-boxes"), ("blue-dot", "selected more than once"), ("blue-dot", "not a candidate"), ("blue-dot", "not a candidate"), ("{x}", "not a clean slug")], key=str)
    assert not any("near" in i for _, i in rows(concepts.selection_issues(chosen, known, flagged, flagged)))
    assert rows(concepts.selection_issues(chosen.limit(0), known, flagged)) == [(None, "nothing selected")]


def test_near_duplicates_of_long_and_empty_forms_equal_all_pairs(spark):
    import itertools
    import random

    rng = random.Random(3)
    words = sorted({"-".join(rng.choices(["a", "ab", "abc", "s", "xabc", "bs", "q" * 90, "glass", "gas"], k=rng.randint(1, 4))) for _ in range(60)} | {"s", ""})
    df = spark.createDataFrame([(w,) for w in words], "slug string")
    norm = {r.slug: r.n for r in df.select("slug", text.normal_slug("slug").alias("n")).collect()}

    def near(a, b):
        x, y = set(norm[a].split("-")), set(norm[b].split("-"))
        return norm[a] == norm[b] or norm[a] in norm[b] or norm[b] in norm[a] or len(x & y) / len(x | y) >= 0.6

    want = {tuple(sorted(p)) for p in itertools.combinations(words, 2) if near(*p)}
    assert {(r.a, r.b) for r in concepts.near_duplicates(df).collect()} == want


def test_ranks_and_batches_count_all(spark):
    import random

    rng = random.Random(4)
    made = [("".join(rng.choices("ab-z", k=rng.randint(0, 6))) + str(i), rng.randint(0, 3)) for i in range(300)]
    got = concepts.ranked(spark.createDataFrame(made, "slug string, score int").repartition(5)).collect()
    assert [(r.slug, r.score) for r in sorted(got, key=lambda r: r["rank"])] == sorted(made, key=lambda r: (-r[1], r[0])) and {r["rank"] for r in got} == set(range(1, 301))
    seen = [(f"c{k % 40}", f"u{k % 3}", (k * 7919) % 5_000_000) for k in range(400)]
    first = {}
    for c, _, o in seen:
        first[c] = min(first.get(c, o), o)
    batches = {r.chapter: r.batch for r in dispatch.batches(spark.createDataFrame(seen, "chapter string, unit_id string, ord long")).collect()}
    assert sorted(batches, key=batches.get) == sorted(first, key=first.get) and set(batches.values()) == set(range(1, 41))


def test_dispatch_shapes_and_manifest(spark):
    one = '{"jobs": {"t1": " j1 ", "t2": {"run_id": "j2", "model": "m"}}, "tasks": [{"id": "t1", "launcher": "cli"}, 5, {"id": ""}], "runs": [{"planned_task_id": "t2", "actual_model": "n"}, {"task": "t3", "job": "j3"}]}'
    rows_ = dispatch.record_rows(spark.createDataFrame([(1, one), (2, "{"), (3, None)], "ord int, json string"))
    got = {r.id: (r.job_id, r.runtime, r.model) for r in dispatch.normal_records(rows_).collect()}
    assert got == {"t1": ("j1", "cli", None), "t2": ("j2", None, "n"), "t3": ("j3", None, None)}
    tasks = spark.createDataFrame([("u", "a", "t1"), ("u", "b", "t2"), ("u", "c", "t9"), ("v", "a", "t3")], "unit_id string, lane string, task_id string")
    checked = spark.createDataFrame([("u", "a", True, 0), ("u", "b", False, 3)], "unit_id string, lane string, valid boolean, issues long")
    manifest = dispatch.run_manifest(tasks, dispatch.normal_records(rows_), checked)
    assert rows(manifest, "task_id", "state", "issues") == [("t1", "valid", 0), ("t2", "invalid", 3), ("t3", "unverified", 0), ("t9", "unrecorded", 0)]
    outputs = spark.createDataFrame([("u", "a"), ("u", "a")], "unit_id string, lane string")
    assert rows(dispatch.discipline(tasks, dispatch.normal_records(rows_), outputs)) == [("a", 2, 2, 1), ("b", 1, 1, 1), ("c", 1, 0, 1)]
    tokens = spark.createDataFrame([("1", "5"), ("2", "2.9"), ("3", "null"), ("4", None)], "k string, j string").select("k", F.parse_json("j").alias("v"))
    assert rows(tokens.select("k", text.optional_tokens("v"))) == [("1", 5), ("2", 2), ("3", None), ("4", None)]
    for bad in ("-1", "true", '"5"', "[]"):
        with pytest.raises(Exception, match="count of tokens"):
            spark.createDataFrame([(bad,)], "j string").select(text.optional_tokens(F.parse_json("j"))).collect()


def test_evidence_of_pages(spark):
    parts = spark.createDataFrame([("u", "One", " none "), ("u", "Relations", "has ^d-ch01-0002"), ("v", "One", None)], "unit_id string, header string, body string")
    own = spark.createDataFrame([("u", 0, "d-ch01-0001", "first"), ("u", 1, "d-ch01-0002", "second"), ("u", 2, "d-ch01-0003", " ")], "unit_id string, pos int, block_id string, text string")
    targets = spark.createDataFrame([("u", "raw/c")], "unit_id string, target string")
    got = {(r.unit_id, r.header): r.body for r in pages.with_evidence(parts, own, targets).collect()}
    assert got["u", "One"] == "none\n\nEvidence anchors:\n- ![[raw/c#^d-ch01-0001]]\n- ![[raw/c#^d-ch01-0002]]" and got["v", "One"] == ""
    assert got["u", "Relations"] == "has ^d-ch01-0002\n\nUnit evidence corpus:\n- ![[raw/c#^d-ch01-0001]] — first\n- ![[raw/c#^d-ch01-0003]] — d-ch01-0003"
    made = spark.createDataFrame([("c", ["d-ch01-0002", "d-ch01-0009"])], "slug string, block_ids array<string>")
    index = pages.evidence_index(made, spark.createDataFrame([("u", "x ^d-ch01-0002"), ("t", "^d-ch01-0002")], "unit_id string, text string"))
    refs = spark.createDataFrame([("d-ch01-0002", "raw/c")], "block_id string, ref string")
    assert pages.evidence_section(index, refs, "src").first().markdown == "## Evidence index\n\n1. `^d-ch01-0002` — unit(s): t, u\n   - ![[raw/c#^d-ch01-0002]]\n2. `^d-ch01-0009` — unit(s): unknown unit\n   - ![[src#^d-ch01-0009]]"
    said = spark.createDataFrame([("p", "![[raw/c#^d-ch01-0002]] [[raw/c#^d-ch01-0009]] ^d-ch01-0009")], "page string, text string")
    assert rows(pages.dead_citations(said, refs, "page")) == [("p", "dead block id: d-ch01-0009")]
    vault = spark.createDataFrame([("raw/c.md", "x ^d-ch01-0002")], "file string, text string")
    assert rows(pages.dead_link_issues(said, vault, "page")) == [("p", "anchor_missing: [[raw/c#^d-ch01-0009]]")]


def test_sections_of_presentations(spark):
    body = "## One\ntext ^d-ch01-0001\n## Two\n\n## One\nagain\n## Odd\nx"
    got = {r.issue for r in pages.presentation_issues(spark.createDataFrame([("u", body)], "unit_id string, text string"), ["One", "Two", "Three"]).collect()}
    assert {"missing section: Three", "unexpected section: Odd", "duplicate section", "empty section: Two", "too few embeds", "too few quotes"} <= got
    assert rows(pages.assemble(spark.createDataFrame([("u", "B", "b"), ("u", "A", "a"), ("u", "C", "c")], "unit_id string, header string, body string"), spark.createDataFrame([("A", 0), ("B", 1)], "header string, place int"))) == [("u", "## A\n\na\n\n## B\n\nb")]
    own = spark.createDataFrame([("u", "d-ch01-0001"), ("u", "d-ch01-0002")], "unit_id string, block_id string")
    assert rows(pages.uncited(own, spark.createDataFrame([("u", body)], "unit_id string, text string"))) == [("u", "d-ch01-0002")]
    found = spark.createDataFrame([("s", "u", 1, "b1", "Formulas", "x  y"), ("s", "u", 2, "b2", "Definitions", "z" * 200)], "slug string, unit_id string, line_no int, block_id string, category string, text string")
    assert pages.source_index(found).first().markdown == f"## Definitions\n- `^b2` {'z' * 160}\n\n## Formulas\n- `^b1` x y"


def test_claims_of_order_lines_gather_no_lists(spark, tmp_path):
    from attestry.plans import claim_queries

    spark.createDataFrame([(1, 7, 3, 1), (1, 7, 10, 2), (1, 8, 4, 3), (2, 7, 3, 1)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = claim_queries.attached_claims(spark, str(tmp_path))
    assert "collect_list" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found, "slug", "file", "block_id", "l_linenumber") == [("s3", 1, "7", 1), ("s3", 1, "7", 2), ("s3", 2, "7", 1), ("s4", 1, "8", 3)]
