"""The entry point without the optional corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left", ["nothing", "empty folder"])
def test_entry_loads_without_the_corpus_operators(tmp_path, left):
    shutil.copytree(os.path.join(ROOT, "credscope"), tmp_path / "credscope", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    if left == "empty folder":
        (tmp_path / "credscope" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), sorted(set(e.oracle_sql()) - set(q)), any(n.startswith('op') for n in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 40 and out[1] == "[]"
