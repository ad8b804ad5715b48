"""The library without its optional subpackage."""

import os
import shutil
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import __spark_entry__ as E
assert "pipeline" not in E.queries() and not any(k.startswith("op") for k in E.queries())
print(len(E.queries()), len(E.oracle_sql()))
"""


def copy_without(*gone):
    to = tempfile.mkdtemp(prefix="without-llm-") + "/repo"
    shutil.copytree(ROOT, to, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *gone))
    return to


def run(at, *args):
    return subprocess.run([sys.executable, *args], cwd=at, capture_output=True, text=True, timeout=300,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_imports_without_the_subpackage():
    from cropscope.plans import QUERIES, SQL
    for gone in (("llm",), ("llm", "corpus_pipeline.py")):
        at = copy_without(*gone)
        got = run(at, "-c", PROBE)
        assert got.returncode == 0, got.stderr
        assert got.stdout.split() == [str(len(QUERIES)), str(len(SQL))]
        tests = run(at, "-m", "pytest", "tests", "--collect-only", "-q")
        assert tests.returncode == 0, tests.stdout[-2000:]
        assert "llm" not in tests.stdout.replace(at, "")
