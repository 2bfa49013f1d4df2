"""The corpus pipeline on a small corpus with planted cases."""

import numpy as np
import pytest

import corpus_pipeline


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(3000)]
    line = lambda n: " ".join(rng.choice(words, n))
    item, passage, body = line(30), line(60), line(400)
    near = body.split(" ")
    near[7] = near[200] = "changed"
    rows = [(i, f"{line(40)}\n{line(30)}", "en", "s", 1) for i in range(20)]
    rows += [(100, body, "en", "s", 1), (101, " ".join(near), "en", "s", 1), (102, f"{line(20)}\n{passage}\n{line(20)}", "en", "s", 1), (103, f"{line(20)}\n{passage}\n{line(20)}", "en", "s", 1), (104, f"{line(40)} {item}", "en", "s", 1), (105, None, "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), passage


def test_stages(spark, corpus):
    path, passage = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == columns, name
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert set(range(20)) <= set(kept) and {100, 102, 103} <= set(kept)
    assert not {101, 104} & set(kept)
    assert passage in kept[102] and passage not in kept[103]


def test_run(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus[0]).collect()
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict()) and len({r.doc_id for r in rows}) >= 23


def test_stages_on_odd_input(spark, corpus):
    path, _ = corpus
    kinds = "doc_id long, text string, lang string, source string, n_chars long, score string"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "five words are not many"), (5, "another text of this id"), (None, "no id"), (None, None), (6, "A" * 120_000), (7, "word " * 30_000)]
    odd = spark.createDataFrame([(*r, None, "s", 0, "own") for r in rows], kinds)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd.limit(0), path).count() == 0, name
        out = stage(spark, odd, path)
        assert out.columns == odd.columns, name
        kept = [r.doc_id for r in out.collect()]
        # texts of less than a shingle link when equal; null, empty and blank texts are equal
        want = [1, 4, 4, 5, 5, 6, 7, None, None] if name == "near duplicates" else [1, 2, 3, 4, 4, 5, 5, 6, 7, None, None]
        assert sorted(kept, key=str) == sorted(want, key=str), name
    packed = corpus_pipeline.STAGES[-1][1](spark, odd, path)
    assert packed.filter("start = 0").count() == len(rows) and corpus_pipeline.STAGES[-1][1](spark, odd.limit(0), path).count() == 0


def test_component_of_null_ids(spark):
    from attestry.llm import simhash

    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(None, text), (None, text), (3, "other words here")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.component_id) for r in simhash.query(df).collect()), key=str) == [(3, 3), (None, None), (None, None)]
    assert simhash.keep_first(df).count() == 3
