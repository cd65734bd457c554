import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from listenlens.llm import registry

SF = "/root/testdata/sf0.01"
REPO = os.path.dirname(os.path.abspath(entry.__file__))


def test_every_operator_is_registered_once():
    names = registry.queries()
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())
    assert set(registry.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_matches_the_sql_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    con.execute(registry.oracle_sql()[name])
    order = [c[0] for c in con.description]
    want = [tuple(dict(zip(order, r))[c] for c in columns) for r in con.fetchall()]
    assert sorted(order) == columns
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(repr, want))


def test_the_rest_works_without_the_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": str(copy)})


def test_python_workers_find_the_package(tmp_path):
    code = f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
sys.path.insert(0, {REPO!r})
import __spark_entry__ as e
assert e.queries()["op3_quality_rules"](spark, "/root/testdata/sf0.001").count() > 0
assert e.queries()["op8_warc_zstd"](spark, "/root/testdata/sf0.001").count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env=env)


def test_nothing_else_imports_the_operators():
    for folder, _, files in os.walk(os.path.join(REPO, "listenlens")):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                assert "listenlens.llm" not in open(os.path.join(folder, f)).read(), f
