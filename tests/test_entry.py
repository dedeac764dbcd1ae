"""The entry in a copy of the repository that lacks the subpackage, the pipeline or a library."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = "import sys; {}; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


@pytest.mark.parametrize(("gone", "first"), [
    (["tallyhouse/llm", "tests/llm"], "pass"),
    (["tallyhouse/llm", "tests/llm", "corpus_pipeline.py"], "pass"),
    ([], "sys.modules['ahocorasick'] = None"),
])
def test_the_rest_works_alone(tmp_path, gone, first):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *[x.rsplit("/", 1)[-1] for x in gone]))
    out = subprocess.run([sys.executable, "-c", CODE.format(first)], cwd=copy, capture_output=True, text=True, check=False)
    assert out.returncode == 0, out.stderr
    queries, sql, pipeline = out.stdout.split()
    assert queries == sql and int(queries) > 100 and pipeline == "False"
