"""Every registered query with SQL gives the same rows as DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from attestry.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def shown(v):
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(tuple(map(shown, r)) for r in df.select(*columns).collect())
    if name not in catalogue.ORACLES:
        assert rows
        return
    found = con.sql(catalogue.ORACLES[name])
    assert sorted(found.columns) == columns
    assert rows == sorted(tuple(map(shown, r)) for r in found.project(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_entry_works_without_the_optional_folder(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(__file__).resolve().parent.parent
    shutil.copytree(top / "attestry", tmp_path / "attestry", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(*sorted(e.queries()), *sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [*sorted(catalogue.QUERIES), *sorted(catalogue.ORACLES)], out.stderr


def test_text_marks_of_blank_last_lines_and_hidden_marks(spark, tmp_path):
    texts = ["a\n\n", "\n", "b\n\u4e2d\u6587", "c\n[# d\n", "^## e\nf", "  title: g\nh", "[title: i\n## ## j", "#title: k\n\n\n", "l\n- related_to::m", "", None, "n\n[#o\n\u00e9\n"]
    docs = [(k, t, "s") for k, t in enumerate(texts * 3)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = catalogue.QUERIES["text_marks"](spark, str(tmp_path))
    columns = sorted(found.columns)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(catalogue.ORACLES["text_marks"]).project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert len(want) == 30
    assert sorted(tuple(map(shown, r)) for r in found.select(*columns).collect()) == sorted(tuple(map(shown, r)) for r in want)
