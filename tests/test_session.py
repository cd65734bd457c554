import os
import subprocess
import sys

import pytest

from listenlens import session

REPO = os.path.dirname(os.path.dirname(os.path.abspath(session.__file__)))


def test_entry_loads_without_jars_and_jvm():
    """queries() and oracle_sql() need neither Spark's jar folder nor a JVM."""
    code = """
import builtins, glob, os, subprocess, zipfile
glob.glob = lambda *a, **k: []
def refuse(*a, **k): raise RuntimeError("not at import")
zipfile.ZipFile = subprocess.Popen = refuse
import __spark_entry__ as e
assert len(e.queries()) > 60 and len(e.oracle_sql()) > 55
"""
    env = {**os.environ, "PYTHONPATH": REPO, "SPARK_HOME": "/nonexistent", "JAVA_HOME": "/nonexistent"}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=REPO, env=env)


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return {}

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, named=None):
        self.sparkContext, self.conf = _Context(master), {"spark.checkpoint.dir": named} if named else {}


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(_Session("spark://host:7077"))
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(_Session("local-cluster[2,1,1024]"))
    assert session.ensure_checkpoint_dir(_Session("yarn", "hdfs://shared/ck")) == "hdfs://shared/ck"
    assert os.path.isdir(session.ensure_checkpoint_dir(_Session("local[4]")))


def test_tables_go_to_the_named_folder(spark):
    assert session.shared_path(spark, "x").startswith(session.ensure_checkpoint_dir(spark))


def run_elsewhere(tmp_path, name: str) -> None:
    """A query in a session whose folder and path know nothing of the repository."""
    code = f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").getOrCreate()
sys.path.insert(0, {REPO!r})
import __spark_entry__ as e
assert e.queries()[{name!r}](spark, "/root/testdata/sf0.001").count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env=env)


def test_python_workers_find_the_package(tmp_path):
    run_elsewhere(tmp_path, "recommend_user")
