"""The driver contract where packages of the corpus operators are missing."""

import os
import subprocess
import sys

import pytest

from conftest import ROOT

HIDE = """
import sys
sys.path.insert(0, {root!r})
sys.modules[{name!r}] = None
import __spark_entry__ as entry
names = set(entry.queries())
assert "outlier_summary" in names and not [n for n in names if n.startswith("op")] and "pipeline" not in names
assert set(entry.oracle_sql()) <= names
"""


@pytest.mark.parametrize("name", ["ahocorasick", "public_tokenizers", "corpus_pipeline", "plumbline.llm"])
def test_tabular_queries_survive_a_missing_module(name):
    done = subprocess.run(
        [sys.executable, "-c", HIDE.format(root=ROOT, name=name)], capture_output=True, text=True, cwd=os.path.dirname(ROOT)
    )
    assert done.returncode == 0, done.stderr[-800:]
    assert "not registered" in done.stderr
