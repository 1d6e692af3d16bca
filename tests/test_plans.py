"""Every registered query against its SQL, on the smallest tables."""

import ast
import os
import shutil
import subprocess
import sys

import pytest
from oracle import ROOT, compare, duck

from __spark_entry__ import entry, oracle_sql, queries as registered
from rowferry.plans import all_oracles, all_queries as queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return duck(FOLDER)


def test_every_query_has_its_sql():
    assert set(queries()) == set(all_oracles())
    assert set(queries()) <= set(registered()) and set(all_oracles()) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, db, name):
    n, difference = compare(spark, db, name, queries()[name], all_oracles()[name], FOLDER)
    assert difference is None and n > 0


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) > 0 and set(rows[0].asDict()) == {"n_name", "orders", "total"}


@pytest.mark.parametrize("without", [("rowferry/llm",), ("rowferry/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_entry_without_the_operators_for_training_data(tmp_path, without):
    """A copy of the tree without these still imports and lists the other queries."""
    shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda folder, names: [
        n for n in names if n in (".git", "__pycache__") or os.path.relpath(os.path.join(folder, n), ROOT) in without])
    script = "import __spark_entry__ as e; print(sorted(e.queries())); e.oracle_sql()"
    found = subprocess.run([sys.executable, "-c", script], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr
    names = ast.literal_eval(found.stdout)
    assert "snk_csv" in names and ("pipeline" in names) == (not without)
    assert any(n.startswith("op") for n in names) == ("rowferry/llm" not in without)


def test_entry_takes_no_pipeline_of_another_tree(tmp_path):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__", "corpus_pipeline.py")])
    script = "import __spark_entry__ as e; print(sorted(e.queries())); e.oracle_sql()"
    found = subprocess.run([sys.executable, "-c", script], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120,
                           env=os.environ | {"PYTHONPATH": str(ROOT)})
    assert found.returncode == 0, found.stderr
    names = ast.literal_eval(found.stdout)
    assert "op8_packing" in names and "pipeline" not in names
