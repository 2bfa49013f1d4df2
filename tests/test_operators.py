"""Operators on small inline cases."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from attestry.functions import rules, text
from attestry.operators import blocks, chapters, concepts, control, dispatch, grounding, images, links, ocr, pages, validate
from attestry.plans import document_queries, graph_queries
from attestry.sources import files, sinks
from attestry.streaming import ledger


def values(spark, column, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


CASES = {
    "Entropy is defined as the mean information of a source.": rules.DEFINITIONS,
    "The loss is $x^2 + 1$ here.": rules.FORMULAS,
    "Formula: \\frac{a}{b}": rules.FORMULAS,
    "import numpy": rules.EXAMPLES,
    "See Figure 3 for this": rules.EXAMPLES,
    "However, the method is quite fragile in practice": rules.WARNINGS,
    "Smith et al. did so": rules.HISTORY,
    "two words": rules.TRANSITION,
    "In this chapter you go on": rules.TRANSITION,
    "a b c d e f g h i j k you should take it": rules.WARNINGS,
    "a b c d e f g h i j k so for example it": rules.EXAMPLES,
    "a b c d e f g h i j k the dataset it": rules.HISTORY,
    "": rules.TRANSITION,
}


def test_categories(spark):
    assert values(spark, text.category("t"), list(CASES)) == list(CASES.values())


def test_keyword_is_bounded(spark):
    assert values(spark, text.category("t"), ["the homework of mine today"]) == [rules.TRANSITION]


def test_slugs(spark):
    given = ["gambler-s-ruin", "arc-sine-laws", "class-gas", "Pass"]
    assert values(spark, text.normal_slug("t"), given) == ["gambler-ruin", "arc-sine-law", "class-gas", "pass"]
    assert values(spark, text.is_slug("t"), ["a-b", "A", "a--b", "", None, "a" * 81]) == [True, False, False, False, False, False]
    assert values(spark, text.is_clean_slug("t"), ["quadratic-form", "ab", "3-body", "fine-slug", "x{y"]) == [False, False, False, True, False]


def test_names(spark):
    assert values(spark, text.clean_title("t"), ["## **Big**  <b>Thing</b> "]) == ["Big Thing"]
    assert values(spark, text.file_stem("t", F.lit(3)), ["Über uns: Teil 1!", "?"]) == ["ch-03-über-uns-teil-1", "ch-03-untitled"]
    assert values(spark, text.unit_id(F.lit(8), "t"), ["ch-08-x-part2", "ch-08-x"]) == ["ch08-part02", "ch08"]
    assert values(spark, text.chapter_number("t"), ["ch-07-x", "part-3", "notes"]) == [7, 0, None]
    assert values(spark, text.is_synthetic_id("t", F.lit("plan")), ["plan", "run-fake-1", "r9"]) == [True, True, False]
    assert values(spark, text.numberless_title("t"), [" 1.2 Title"]) == ["Title"]


def test_lines_and_quotes(spark):
    assert values(spark, text.lines("t"), ["a\r\nb\nc\n", "a b", ""]) == [["a", "b", "c"], ["a", "b"], []]
    assert values(spark, text.normal_quote("t"), ["*a*  `b`\n c"]) == ["a b c"]
    assert values(spark, text.quote_lines("t"), ["> short\n> a line that is long enough\n> ![[x#^y]] long enough too"]) == [1]
    assert values(spark, text.placeholder("t"), ["a TODO here", "mastodon", "[insert name]"]) == [True, False, True]
    assert values(spark, text.strip_ref("t"), ['"a.png"', "a.png title", "./a b.png"]) == ["a.png", "a.png", "./a b.png"]
    assert values(spark, text.is_image_url("t"), ["https://h/a.PNG?x", "http://h/ocr%2Fcrop/1", "https://h/a.txt", "a.png"]) == [True, True, False, False]


def test_hygiene(spark):
    given = ["^[a-ch1-1]", "![[a#^b]]]", "- defined_by::[[a]]", "- related_to::[[a]]", "clean"]
    assert list(map(len, values(spark, text.hygiene("t"), given))) == [1, 1, 1, 1, 0]


def chapter(spark, body, file="f", number=1):
    return spark.createDataFrame([("demo", number, file, body)], "slug string, chapter int, file string, text string")


def test_annotation(spark):
    body = "---\ntitle: x\n---\n# Head\nFirst.\n\n| a |\n| b |\nTail.\n<!-- c\nhidden\n-->\n<!-- one -->\nEnd."
    got = blocks.annotate(chapter(spark, body)).orderBy("line_no").collect()
    assert [(r.line_no, r.block_id[-4:]) for r in got] == [(5, "0001"), (8, "0002"), (9, "0003"), (14, "0004")]


def test_annotation_keeps_ids(spark):
    body = "First. ^demo-ch01-0007\n| a |\n\n^demo-ch01-0008\nNew.\n| b | ^demo-ch01-0009\n| c |\nOther. ^else-ch01-0001"
    got = blocks.annotate(chapter(spark, body)).orderBy("line_no").collect()
    assert [(r.line_no, r.block_id) for r in got] == [(2, "demo-ch01-0010"), (5, "demo-ch01-0011"), (8, "demo-ch01-0012")]


def test_annotation_counts_over_files(spark):
    two = chapter(spark, "a b c\nd", "f1").union(chapter(spark, "e", "f2")).union(chapter(spark, "z", "g", 2))
    got = blocks.annotate(two).orderBy("chapter", "file", "line_no").collect()
    assert [r.block_id for r in got] == ["demo-ch01-0001", "demo-ch01-0002", "demo-ch01-0003", "demo-ch02-0001"]


def test_extract_blocks(spark):
    got = blocks.extract_blocks(chapter(spark, "Some text. ^demo-ch01-0001\n| t |\n\n^demo-ch01-0002"), "demo").orderBy("line_no").collect()
    assert [(r.block_id, r.text) for r in got] == [("demo-ch01-0001", "Some text."), ("demo-ch01-0002", "| t |")]


def test_multisets(spark):
    a, b = (spark.createDataFrame([(x,) for x in s], "k string") for s in ("aabc", "abcd"))
    assert {tuple(r) for r in blocks.multiset_difference(a, b, "k").collect()} == {("a", 1, 0), ("d", 0, 1)}


def test_balance(spark):
    rows = [("u", "definitions", 8, 3, True), ("u", "warnings", 1, 0, True), ("u", "evidence_index", 30, 30, False)]
    got = blocks.balance_findings(spark.createDataFrame(rows, "unit_id string, category string, citations int, embeds int, required boolean"))
    assert {(r.code, r.category) for r in got.collect()} == {("thin_citations", "warnings"), ("thin_embeds", "warnings"), ("citation_monopoly_with_thin_sections", "definitions"), ("evidence_index_dominates_total_citations", "evidence_index")}


def book(spark, lines):
    return spark.createDataFrame([("b", i + 1, x) for i, x in enumerate(lines)], "slug string, line_no int, line string")


@pytest.mark.parametrize(
    ("lines", "method", "titles"),
    [
        (["## Chapter 3: Start", "x", "Chapter 4"], "plain-text-chapter", ["Start", "Chapter 4"]),
        (["<!-- x:doc_title -->", "", "# One", "<!-- y:doc_title -->", "Two"], "doc-title", ["One", "Two"]),
        (["C H A P T E R 1", "ab", "Title", "CHAPTER 2"], "spaced-ocr-chapter", ["Title", "Chapter 2"]),
        (["nothing", "here"], None, []),
    ],
)
def test_detect(spark, lines, method, titles):
    got = chapters.detect_boundaries(book(spark, lines)).orderBy("line_start").collect()
    assert [r.title for r in got] == titles and {r.method for r in got} <= {method}


def test_boundaries(spark):
    rows = spark.createDataFrame([("b", 1, "a", 0, None), ("b", 2, "b", 4, 9), ("b", 3, "c", 7, None)], "slug string, chapter int, title string, line_start int, line_end int")
    got = chapters.normal_boundaries(rows, spark.createDataFrame([("b", 10)], "slug string, line_count int")).orderBy("line_start").collect()
    assert [(r.line_end, r.issue) for r in got] == [(4, None), (9, "overlaps the following chapter"), (10, None)]


def test_split_points():
    assert chapters.split_points([False] * 45, 25, 10) == [25, 45]
    assert chapters.split_points([i == 19 for i in range(45)], 25, 10) == [20, 45]
    assert chapters.split_points([], 5, 2) == [0]
    ends = chapters.split_points([i % 7 == 0 for i in range(1000)], 30, 5)
    assert ends[-1] == 1000 and all(0 < b - a <= 30 for a, b in zip([0, *ends], ends))


def test_units(spark):
    rows = spark.createDataFrame([("s", f) for f in ("ch-01-a.md", "ch-01-b.md", "part-002.md", "notes.md", "ch-03-x-part1.md", "ch-02.orig.md")], "slug string, file string")
    got = {r.file: (r.unit_id, r.ambiguous) for r in chapters.discover_units(rows).collect()}
    assert got == {"ch-01-a.md": ("ch01", True), "ch-01-b.md": ("ch01", True), "part-002.md": ("ch00-part002", False), "ch-03-x-part1.md": ("ch03-part01", False)}


def test_concepts(spark):
    schema = "slug string, name string, chapter int, confidence double, density double, ord int, definitions array<string>, block_ids array<string>"
    rows = [("arc-laws", "A", 1, None, 2.5, 1, ["d"], ["b2"]), ("arc-laws", "B", 2, 0.9, None, 2, [], ["b1"]), ("arc-law", "C", 3, 0.1, 0.0, 3, None, ["b2"]), ("", "x", 1, 1.0, 1.0, 4, [], [])]
    folded = concepts.fold(concepts.merge(spark.createDataFrame(rows, schema))).collect()
    assert len(folded) == 1
    got = folded[0]
    assert (got.slug, got.name, got.chapters, got.confidence, got.source_count, got.merged_slugs, got.block_ids) == ("arc-law", "C", [1, 2, 3], 0.9, 3, ["arc-law", "arc-laws"], ["b1", "b2"])
    scored = concepts.scored(spark.createDataFrame(folded))
    assert scored.first().score == 3 + 1 + 1 + 1 + 1 + 1
    ambiguous = spark.createDataFrame([("b1",), ("b1",), ("",)], "block_id string")
    assert concepts.downweight(scored, ambiguous).first().score == 7


def test_near_duplicates_equal_all_pairs(spark):
    import itertools

    words = ["red-box", "red-boxes", "red-box-small", "box", "blue-box-small", "a-b-c-d-e", "a-b-c-d-f", "a-b-c-x-y", "zz", "red-small-box", "ed-bo"]
    df = spark.createDataFrame([(w,) for w in words], "slug string")
    norm = dict(zip(words, values(spark, text.normal_slug("t"), words)))

    def near(a, b):
        x, y = set(norm[a].split("-")), set(norm[b].split("-"))
        return norm[a] == norm[b] or norm[a] in norm[b] or norm[b] in norm[a] or len(x & y) / len(x | y) >= 0.6

    want = {tuple(sorted(p)) for p in itertools.combinations(words, 2) if near(*p)}
    assert {(r.a, r.b) for r in concepts.near_duplicates(df).collect()} == want


def test_grounding(spark):
    claims = spark.createDataFrame([("b1", "EXTRACTED", "the *quick*  fox"), ("b1", "EXTRACTED", "slow"), ("b9", "EXTRACTED", "x"), ("b1", "INFERRED", "")], "block_id string, confidence string, quote_verbatim string")
    got = grounding.ground_claims(claims, spark.createDataFrame([("b1", "See the quick fox.")], "block_id string, text string"))
    assert sorted((r.quote_verbatim, r.demoted) for r in got.collect()) == [("", False), ("slow", True), ("the *quick*  fox", False), ("x", True)]
    rates = grounding.demotion_rates(got.withColumn("u", F.lit(1)), ["u"]).first()
    assert (rates.extracted, rates.demoted, rates.fails) == (3, 2, True)


def test_quotes_in_texts(spark):
    docs = spark.createDataFrame([(1, "so one two three four five six seven on"), (2, "short one"), (3, None)], "doc_id int, text string")
    quotes = spark.createDataFrame([(1, "ne two three four five six sev"), (2, "ort o"), (3, "absent words are not in any text"), (4, None)], "item_id int, text string")
    assert {tuple(r) for r in grounding.quotes_in_texts(quotes, docs).collect()} == {(1, 1), (2, 2)}


def vault(spark):
    return spark.createDataFrame(graph_queries.VAULT, "file string, text string")


def test_links(spark):
    got = {(r.raw): (r.status, r.resolved) for r in links.resolve_links(links.extract_links(vault(spark)), vault(spark)).collect()}
    assert got["![[raw/papers/demo/ch-01-start#^demo-ch01-0001]]"] == ("ok", "raw/papers/demo/ch-01-start")
    assert got["[[demo/ch-02-end#^demo-ch02-0001]]"] == ("suffix_match", "raw/papers/demo/ch-02-end")
    assert got["[[demo-ch01-0002]]"][0] == "malformed_anchorless_id"
    assert got["![[raw/papers/demo/ch-01-start#^[demo-ch01-0001]]]"][0] == "malformed_bracket_anchor"
    fixed = {r.file: r for r in links.repair(vault(spark), links.owners(vault(spark))).collect()}["concepts/page.md"]
    assert "`^demo-ch01-0009` *(unresolved source block)*" in fixed.text and fixed.unresolved == 1
    assert "[[raw/papers/demo/ch-01-start#^demo-ch01-0002|^ch01-0002]]" in fixed.text


def test_control(spark):
    rows = spark.createDataFrame([("a", "READY_FOR_3.3"), ("b", "FAILED"), ("c", "ODD"), ("d", None)], "slug string, status string")
    assert {r.slug: r.next for r in control.next_action(rows).collect()} == {"a": "3.3", "b": "blocked", "c": "drift", "d": "start"}
    recorded = spark.createDataFrame([("s", "1"), ("s", "2.1")], "slug string, phase string")
    found = spark.createDataFrame([("s", "1", "FAIL"), ("s", "3.0", "PASS")], "slug string, phase string, status string")
    assert {(r.phase, r.issue) for r in control.drift(recorded, found, ["slug", "phase"]).collect()} == {("1", "not ready"), ("2.1", "missing gate"), ("3.0", "unrecorded gate")}
    a = spark.createDataFrame([("s", "x", "1"), ("s", "y", "2")], "slug string, name string, content string")
    one, two = (control.tree_fingerprints(d, "slug", "name", "content") for d in (a, a.orderBy(F.desc("name"))))
    assert one.first() == two.first()
    done = spark.createDataFrame([("s", "READY_FOR_POST", True, True), ("t", "READY_FOR_POST", True, False)], "slug string, status string, audit_pass boolean, grounding_pass boolean")
    assert {r.slug: r.status for r in control.finalize(done).collect()} == {"s": "DONE", "t": "READY_FOR_POST"}


def test_dispatch(spark):
    records = spark.createDataFrame([("t1", None, " j1 ", None, "m", 1), (None, "t1", None, "r7", None, 2), ("t2", None, "fake-1", "t2", None, 3)], "id string, planned_task_id string, job_id string, task_id string, model string, ord int")
    normal = dispatch.normal_records(records)
    assert {r.id: (r.job_id, r.runtime_task_id, r.model) for r in normal.collect()} == {"t1": ("j1", "r7", "m"), "t2": ("fake-1", "t2", None)}
    tasks = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "task_id string")
    assert {(r.task_id, r.issue) for r in dispatch.record_issues(tasks, normal).collect()} >= {("t2", "synthetic job_id"), ("t2", "synthetic runtime_task_id"), ("t3", "missing job_id")}


def layouts(spark):
    return ocr.render_regions(ocr.layout_regions(document_queries.literal(spark, document_queries.LAYOUTS, "slug")))


def test_layouts(spark):
    got = {r.slug: r.markdown for r in ocr.rebuild(layouts(spark)).collect()}
    assert got["chunked"].index("Earlier") < got["chunked"].index("Later")
    assert "# A Title" in got["plain"] and got["plain"].index("# A Title") < got["plain"].index("Second") and "```python" in got["flat"]
    assert "| 1   | 2    | 3   |" in got["plain"]
    assert {r.slug: r.status for r in ocr.fidelity(layouts(spark)).collect()}["plain"] == "PASS"


def test_schema(spark):
    got = {}
    for r in validate.schema_issues(validate.read_extractions(document_queries.literal(spark, [*document_queries.EXTRACTIONS, ("broken", "{")], "file"))).collect():
        got.setdefault(r.file, []).append(r.issue)
    assert set(got) == {"no quote", "short", "empty definitions", "nothing", "bad bounds", "broken"}
    outputs = spark.createDataFrame([("u", "math", "## Author's Formulation\n## More\n^a-ch1-1")], "unit_id string, lane string, text string")
    lanes = spark.createDataFrame([("math", ["Author's Formulation"])], "lane string, required_sections array<string>")
    assert [r.issue for r in validate.markdown_issues(outputs, lanes).collect()] == ["forbidden section: More"]


def test_pages(spark):
    body = "---\n" + "".join(f"{k}: x\n" for k in pages.KEYS) + "---\n## Author's Words\n" + "> a quote that is long enough ^demo-ch01-0001\n" * 2 + "- extracted_from::[[c#^demo-ch01-0001]]\n" + "![[c#^demo-ch01-0001]]\n" * 80
    drafts = spark.createDataFrame([("good", body), ("bad", "TODO derived_from:: ^other-ch01-0001")], "page string, text string")
    assert {r.page for r in pages.page_issues(drafts, "demo", ["Author's Words"]).collect()} == {"bad"}
    shown = spark.createDataFrame([("d/ch-01.md", "![a](imgs/one.png) ![b](two.png \"t\") ![c](http://x/y.png)")], "file string, text string")
    listing = spark.createDataFrame([("d/imgs/one.png", 5), ("d/two.png", 0)], "path string, length long")
    assert [r.state for r in images.verify(images.image_refs(shown), listing).orderBy("ref").collect()] == ["remote", "resolved", "missing"]
    cs = spark.createDataFrame([("c", "1.2 Name", None, ["b1", "b2"], {"One": "text", "Two": ""}, "> a quote that is long enough")], "slug string, name string, confidence double, block_ids array<string>, section_bodies map<string,string>, author_words string")
    page = pages.render(cs).first().markdown
    assert 'title: "Name"\n' in page and "confidence: 0.5\n" in page and "quality: 0.21\n" in page
    marks = images.markers(spark.createDataFrame([("u", 3, "VISION_TABLE VISION_TABLE ^d-ch01-0001")], "unit_id string, line_no int, line string"))
    assert sorted(r.id for r in marks.collect()) == ["u-L0003-VISION_TABLE-1", "u-L0003-VISION_TABLE-2"]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/ch-01.md").write_text("---\ntitle: \"T\"\n---\nbody")
    (tmp_path / "in/ch-01.orig.md").write_text("old")
    (tmp_path / "in/a-defs.json").write_text('[{"source": "x"}, {"source": "y"}]')
    (tmp_path / "in/_skip.json").write_text("{}")
    md = files.markdown(spark, str(tmp_path / "in"))
    assert [r.fields["title"] for r in files.front_matter(md, ["file"]).collect()] == ["T"]
    assert files.extraction_files(spark, str(tmp_path / "in")).count() == 2
    assert files.listing(spark, str(tmp_path / "in")).count() == 3  # hidden names are no data
    with pytest.raises(Exception, match="not a JSON object"):
        files.json_objects(spark, str(tmp_path / "in/a-defs.json")).collect()
    events = spark.createDataFrame([("1", 5, None), ("1", 7, 2), ("3.3", 1, None)], "phase string, tokens_in long, tokens_out long")
    sinks.append_events(events, str(tmp_path / "ledger"))
    (tmp_path / "ledger/bad.json").write_text("{not json\n")
    got = files.ledger(spark, str(tmp_path / "ledger"))
    assert got.filter("bad is not null").count() == 1
    assert control.ledger_totals(got.filter("bad is null"), "phase", ["tokens_in"]).filter("phase is null").first().tokens_in == 13
    stream = ledger.running_totals(ledger.ledger_stream(spark, str(tmp_path / "ledger")))
    query = stream.writeStream.outputMode("complete").format("memory").queryName("totals").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination(60)
    assert {r.phase: r.tokens_in for r in spark.table("totals").collect()} == {"1": 12, "3.3": 1, None: 0}
    sinks.append_log(spark.createDataFrame([(datetime(2024, 1, 2, 3, 4), "a", "b", "c")], "at timestamp, action string, subject string, actor string"), str(tmp_path / "log"))
    assert spark.read.text(str(tmp_path / "log")).first()[0] == "## [2024-01-02 03:04] a | b | c"
    table = sinks.markdown_table(spark.createDataFrame([(2, "x|y"), (1, "z")], "k int, v string"), ["k"]).first().markdown
    assert table.splitlines()[2:] == ["| 1 | z |", "| 2 | x\\|y |"]
    sinks.write_table(events, str(tmp_path / "t"), ["phase"])
    with pytest.raises(Exception, match="exist"):
        sinks.write_table(events, str(tmp_path / "t"))
    links_ = links.index_gaps(spark.createDataFrame([("a",)], "stem string"), spark.createDataFrame([("b",)], "stem string"))
    assert {tuple(r) for r in links_.collect()} == {("b", "missing from index"), ("a", "stale entry")}


def test_image_addresses_in_layouts(spark):
    url = "https://x.org/a.png"
    raw = '{"%s": 1, "a": ["see %s, and \\"%s\\"", {"b": "https://x.org/page"}], "c": "imgs/q"}' % (url + "k.png", url, "HTTPS://x.org/b.JPG")
    df = spark.createDataFrame([(1, raw), (2, '{"images/": "no"}'), (3, "broken"), (4, None)], "i int, j string").orderBy("i")
    assert [r[0] for r in df.select(images.json_urls("j")).collect()] == [[url, "HTTPS://x.org/b.JPG"], [], [], []]
    assert [bool(r[0]) for r in df.select(images.json_has_images("j")).collect()] == [True, False, False, False]
    kinds = "k int, label string, native_label string, content string, image_path string, source_url string, file_url string, url string"
    rows = [
        (1, "text", None, f" {url} ", None, None, None, None),
        (2, "Figure", None, "caption", "", None, None, "https://x.org/b.png"),
        (3, "text", "text", f"![]({url}) and ({url})", None, None, None, None),
        (4, None, None, "plain", None, None, None, None),
    ]
    assets = spark.createDataFrame([(url, "imgs/1.png"), (f"{url}x", "no")], "url string, local string")
    out = {r.k: r for r in images.local_regions(spark.createDataFrame(rows, kinds), assets, ["k"]).collect()}
    assert (out[1].content, out[1].image_path, out[1].source_url, out[1].is_image) == ("", "imgs/1.png", url, True)
    assert (out[2].content, out[2].image_path, out[2].source_url) == ("caption", "", "https://x.org/b.png")
    assert out[3].content == "![](imgs/1.png) and (imgs/1.png)"
    assert (out[4].content, out[4].image_path, out[4].is_image) == ("plain", None, False)


def test_usage_has_fallbacks(spark):
    df = spark.createDataFrame([("a", '{"usage": {"input_tokens": 3, "completion_tokens": 4}, "model": "m"}'), ("b", '{"result": {"usage": {"prompt_tokens": 1, "output_tokens": 2}}}')], "slug string, json string")
    assert [tuple(r)[-3:] for r in ocr.result_text(df, "d").orderBy("slug").collect()] == [(3, 4, "m"), (1, 2, "d")]


def test_files_beside_a_result(spark):
    results = spark.createDataFrame([("s", "/r/a/x.json"), ("t", "/q/b/y.json"), ("u", "/none/z.json")], "slug string, path string")
    there = [("/r/a/s.md", 5), ("/r/a/x.md", 0), ("/r/book.md", 5), ("/r/images/1.png", 1), ("/q/b/y.md", 1), ("/q/b/imgs/1.png", 1), ("/q/imgs/1.png", 1)]
    out = ocr.beside(results, spark.createDataFrame(there, "path string, length long"))
    assert sorted(map(tuple, out.select("slug", "markdown", "images").collect())) == [("s", "/r/a/s.md", "/r/images"), ("t", "/q/b/y.md", "/q/b/imgs"), ("u", None, None)]


def test_schema_batch_and_its_precondition(spark):
    expected = spark.createDataFrame([("s", "1.json"), ("s", "2.json"), ("t", "1.json"), ("v", "1.json")], "slug string, file string")
    found = spark.createDataFrame([("s", "1.json"), ("s", "3.json"), ("s", "_report.json"), ("t", "1.json"), ("v", "1.json")], "slug string, file string")
    results = spark.createDataFrame([("s", "1.json", True, 0, 0), ("t", "1.json", True, 10, 3), ("v", "1.json", False, 10, 2)], "slug string, file string, valid boolean, extracted long, demoted long")
    out = {r.slug: r for r in validate.schema_batch(expected, found, results).collect()}
    row = lambda s: tuple(out[s][c] for c in ("expected", "total", "valid", "invalid", "unexpected", "missing", "ungrounded", "status"))
    assert row("s") == (2, 1, 1, 1, 1, 1, 0, "FAIL") and row("t") == (1, 1, 1, 0, 0, 0, 1, "PASS") and row("v") == (1, 1, 0, 1, 0, 0, 0, "FAIL")
    marks = [("a", "validated_by: w", "PASS", 1, 1), ("b", None, "PASS", 1, 1), ("c", "by hand", "PASS", 1, 1), ("d", "validated_by: w", "PASS", 0, 0), ("e", "validated_by: w", None, 1, 1)]
    df = spark.createDataFrame(marks, "slug string, marker string, status string, valid long, total long")
    assert sorted(r.slug for r in validate.precondition_issues(df, "w").collect()) == ["b", "c", "d", "e"]


def test_given_boundaries_and_manifests(spark):
    rows = [("s", " ", 1, None), ("s", "b", 0, None), ("s", "c", 5, 4), ("s", "d", 5, 9), ("s", "e", 2, 8), ("s", "f", None, None)]
    bounds = spark.createDataFrame(rows, "slug string, title string, line_start int, line_end int")
    sizes = spark.createDataFrame([("s", 8)], "slug string, line_count long")
    out = chapters.boundary_issues(bounds, sizes, spark.createDataFrame([("s", 5)], "slug string, units long"))
    assert sorted((r.title or "", r.issue) for r in out.collect()) == [("", "unit count differs"), (" ", "missing title"), ("b", "invalid line_start"), ("c", "invalid line_end"), ("d", "invalid line_end"), ("f", "invalid line_start")]
    manifest = spark.createDataFrame([("s", "ch-01-a.md"), ("s", "ch-02-b.md"), ("s", None), ("g", "ch-01-a.md")], "slug string, file string")
    there = spark.createDataFrame([("s", "ch-01-a.md"), ("s", "ch-03-c.md"), ("g", "ch-01-a.md")], "slug string, file string")
    found = chapters.manifest_issues(manifest, there, spark.createDataFrame([("s", 4), ("g", 1)], "slug string, units long"))
    assert sorted((r.slug, r.file or "", r.issue) for r in found.collect()) == [
        ("s", "", "entries and units differ"), ("s", "", "entry without file"), ("s", "", "expected units differ"), ("s", "ch-02-b.md", "file missing"), ("s", "ch-03-c.md", "unit not listed"),
    ]


def test_anchored_texts_keep_the_last(spark):
    df = spark.createDataFrame([("a.md", "# Head ^s-ch01-0001\nplain\nold ^s-ch01-0002 ^s-ch01-0003"), ("b.md", "new ^s-ch01-0002"), ("c.md", None)], "file string, text string")
    assert sorted(map(tuple, grounding.anchored_texts(df).collect())) == [("s-ch01-0001", "a.md", "Head"), ("s-ch01-0002", "b.md", "new")]


def test_annotation_totals(spark):
    df = spark.createDataFrame([("s", 1, "a.md", "# H\none\ntwo ^s-ch01-0001\n"), ("s", 1, "b.md", "three"), ("s", 2, "c.md", None)], "slug string, chapter int, file string, text string")
    out = {r.file: (r.added, r.preserved, r.block_ids, r.substantive_lines) for r in blocks.annotation_totals(df).collect()}
    assert out == {"a.md": (1, 1, 2, 2), "b.md": (1, 0, 1, 1), "c.md": (0, 0, 0, 0), None: (2, 1, 3, 3)}


def test_repair_totals(spark):
    df = spark.createDataFrame([("p.md", "x [[q#^s-ch01-0001]] y [[q#^s-ch01-0009]]"), ("r.md", "none")], "file string, text string")
    fixed = links.repair(df, spark.createDataFrame([("s-ch01-0001", "z")], "block_id string, ref string")).cache()
    assert tuple(links.repair_totals(df, fixed).first()) == (2, 1, 0, 1, 1)
    assert [tuple(r) for r in links.unresolved_examples(fixed).collect()] == [("s-ch01-0009", 1)]


def test_drafts_take_the_page_form(spark):
    first = "---\nother: 1\ntitle: 'A \"b\"'\n---\n\n- has_status::[[x]]\n# A\n\nbody\n---\n## Relations\n- r::[[y]]\nnote\n# After\n- more"
    df = spark.createDataFrame([("one", first), ("two-words", "text"), ("open", "---\ntitle: T\nlost"), ("none", None)], "page string, text string")
    out = {r.page: r for r in pages.redraft(df, ["- in_domain::[[d]]"]).collect()}
    front = lambda p: out[p].markdown.split("---\n", 2)[2]
    assert out["one"].title == 'A "b"' and out["two-words"].title == "Two Words" and out["open"].title == "T" and out["none"].title == "None"
    assert front("one") == "\n- has_status::[[x]]\n\n\n# A\n\nbody\n---\n# After\n\n\n## Relations\n- r::[[y]]\nnote\n- more"
    assert front("two-words") == "\n- in_domain::[[d]]\n\n\ntext\n\n## Relations\n\n"
    assert front("open") == front("none") == "\n- in_domain::[[d]]\n\n\n\n## Relations\n\n"
