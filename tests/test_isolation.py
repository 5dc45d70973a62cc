"""The library without its text subpackage."""

import os
import pathlib
import shutil
import subprocess
import sys

import pytest

from linkweave.sources import scratch

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_entry_works_without_the_text_folders(tmp_path):
    """With both folders deleted and the pipeline still there, all other queries are registered."""
    shutil.copytree(ROOT / "linkweave", tmp_path / "linkweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("from linkweave.llm import mixing\n")
    code = "import __spark_entry__ as e; n = e.queries(); s = e.oracle_sql(); assert len(n) > 50 and set(s) <= set(n) and 'pipeline' not in n; print('fine')"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120, env=env)
    assert said.stdout.strip() == "fine", said.stderr


class _Context:
    master = "spark://host:7077"

    def getConf(self):
        return {}


class _Cluster:
    conf = {}
    sparkContext = _Context()


def test_no_temporary_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_dir(_Cluster())


def test_forget_removes_what_was_written(spark):
    table = scratch.written(spark.range(3).toDF("x"), "some")
    (path,) = {f.rsplit("/", 1)[0].removeprefix("file://") for f in table.inputFiles()}
    assert table.count() == 3 and os.path.isdir(path)
    scratch.forget(spark)
    assert not os.path.exists(path)
