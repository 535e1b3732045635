"""The entry module with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') for q in e.queries()))"


@pytest.fixture()
def copy(tmp_path):
    shutil.copytree(ROOT / "peerscope", tmp_path / "peerscope", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    return tmp_path


def run(folder):
    return subprocess.run([sys.executable, "-B", "-c", COUNT], cwd=folder, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(folder)}, capture_output=True, text=True)


@pytest.mark.parametrize("empty_folder", [False, True])
@pytest.mark.parametrize("pipeline", [False, True])
def test_without_the_subpackage(copy, empty_folder, pipeline):
    """Its folder gone, or left behind without modules; the pipeline file gone or not."""
    if empty_folder:
        (copy / "peerscope/llm/__pycache__").mkdir(parents=True)
    if pipeline:
        (copy / "corpus_pipeline.py").write_text("from peerscope.llm import common\n")
    done = run(copy)
    n, sql, any_op = done.stdout.split()
    assert int(n) == int(sql) > 40 and any_op == "False", done.stderr


def test_an_import_error_inside_is_not_swallowed(copy):
    (copy / "peerscope/llm").mkdir()
    for name, text in (("__init__", ""), ("oracle", "SQL = {}"), ("queries", "import no_such_module")):
        (copy / f"peerscope/llm/{name}.py").write_text(text + "\n")
    (copy / "corpus_pipeline.py").write_text("ORACLE_SQL = None\n")
    done = run(copy)
    assert done.returncode and "no_such_module" in done.stderr
