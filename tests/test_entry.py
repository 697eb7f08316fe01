"""The driver's contract: names, schemas, and the optional subpackage."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 40


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
def test_entry(spark):
    assert entry.entry(spark).columns == ["export_id", "turn", "role", "value"]


def test_rest_works_without_the_optional_part(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = (
        "import sys, importlib.abc\n"
        "class No(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('lumenweave.llm'): raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e\n"
        "assert 'p4_found' in e.queries() and not any(k.startswith('p3') for k in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
