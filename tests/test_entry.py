"""The driver's contract, with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'fact_validation' in q and not any(k.startswith('op') for k in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=os.environ | {"PYTHONPATH": str(copy)})


def test_entry_imports_without_a_session():
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); from pyspark import SparkContext as c; assert c._active_spark_context is None"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, env=os.environ | {"PYTHONPATH": ROOT})


def test_oracles_belong_to_queries():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and "fact_validation" in entry.queries()
