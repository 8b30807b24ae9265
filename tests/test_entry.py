"""The entry module without the training-data subpackage, or without one of the libraries it needs."""

import subprocess
import sys

import pytest

ROOT = __file__.rsplit("/tests/", 1)[0]

BLOCK = """
import importlib.abc, sys
class Block(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as E
print(len(E.queries()), sum(n.startswith("op") for n in E.queries()), set(E.oracle_sql()) <= set(E.queries()))
"""


@pytest.mark.parametrize("name", ["rowmill.llm", "corpus_pipeline", "xxhash", "regex"])
def test_other_queries_are_there(name):
    from rowmill.plans.registry import QUERIES
    out = subprocess.run([sys.executable, "-W", "always", "-c", BLOCK.format(name=name)], cwd=ROOT, capture_output=True, text=True)
    assert out.stdout.split() == [str(len(QUERIES)), "0", "True"], out.stderr[-500:]
    assert ("no training-data queries" in out.stderr) == (name in ("xxhash", "regex"))


def test_a_fault_of_the_library_itself_is_raised():
    out = subprocess.run([sys.executable, "-c", BLOCK.format(name="rowmill.sinks.scratch")], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode and "rowmill.sinks.scratch" in out.stderr
