"""The entry file imports whatever the training-data subpackage lacks."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if any(name == n or name.startswith(n + ".") for n in {names!r}):
            raise ModuleNotFoundError("No module named " + name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
from eventweave.plans import registry
assert set(registry.queries()) <= set(e.queries()) and set(registry.oracle_sql()) <= set(e.oracle_sql())
print(len(set(e.queries()) - set(registry.queries())), "pipeline" in e.queries())
"""


@pytest.mark.parametrize("names", [("eventweave.llm",), ("regex",), ("eventweave.llm", "corpus_pipeline")])
def test_without_the_subpackage_or_its_imports(names):
    got = subprocess.run([sys.executable, "-c", PROBE.format(names=names)], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert got.returncode == 0, got.stderr
    assert got.stdout.split() == ["0", "False"] and "left out" in got.stderr


def test_without_the_pipeline_alone():
    if not os.path.isdir(os.path.join(REPO, "eventweave", "llm")):
        pytest.skip("no training-data subpackage here")
    got = subprocess.run([sys.executable, "-c", PROBE.format(names=("corpus_pipeline",))], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert got.returncode == 0, got.stderr
    assert int(got.stdout.split()[0]) >= 10 and got.stdout.split()[1] == "False"
