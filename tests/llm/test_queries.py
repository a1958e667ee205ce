import importlib
import os
import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from checks.compare import connect, difference
from dqspark.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


def test_each_operator_has_its_query():
    entry = importlib.import_module("__spark_entry__")
    numbers = [int(m[1]) for q in entry.queries() if (m := re.match(r"op(\d+)_", q))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(ORACLES) <= set(QUERIES) and set(QUERIES) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_like_sql(spark, name):
    assert difference(QUERIES[name](spark, DATA), connect(DATA), ORACLES[name]) is None


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_pipeline_like_its_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA).cache()
        now = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns and now <= ids, name
        ids = now
    found = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id for r in found} == ids
    rejected = {r.doc_id for r in QUERIES["op2_robust_outliers"](spark, DATA).where("NOT kept").collect()}
    assert not ids & rejected
    items = duckdb.sql(f"SELECT text FROM '{DATA}/benchmark.parquet'").fetchall()
    assert not [r.doc_id for r in docs.collect() for (t,) in items if t in r.text]


def test_the_rest_works_without_this_subpackage(tmp_path):
    for name in ("checks", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(REPO / name)
    (tmp_path / "dqspark").mkdir()
    for part in (REPO / "dqspark").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (tmp_path / "dqspark" / part.name).symlink_to(part)
    text = (REPO / "__spark_entry__.py").read_text()
    (tmp_path / "entry_copy.py").write_text(text)
    code = "import entry_copy as e; q = e.queries(); print(len(q), any(k.startswith('op') for k in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode == 0 and out.stdout.split()[1] == "False", out.stderr
