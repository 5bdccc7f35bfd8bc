"""The entry module where the subpackage for training data is absent."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import importlib.machinery, sys

class Absent(importlib.machinery.PathFinder):
    @classmethod
    def find_spec(cls, name, path=None, target=None):
        if name in {gone}:
            return None
        return super().find_spec(name, path, target)

sys.meta_path = [f for f in sys.meta_path if f is not importlib.machinery.PathFinder] + [Absent]
import __spark_entry__ as entry
names = set(entry.queries())
assert names and set(entry.oracle_sql()) <= names, names
print(sorted(n for n in names if n.startswith("op") or n == "pipeline"))
"""


def names_without(*gone):
    done = subprocess.run([sys.executable, "-c", SCRIPT.replace("{gone}", repr(set(gone)))], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.strip()


def test_entry_imports_without_the_subpackage():
    assert names_without("tidemark.llm") == "[]"
    assert names_without("tidemark.llm", "corpus_pipeline") == "[]"


def test_the_pipeline_alone_can_be_absent():
    assert "pipeline" not in names_without("corpus_pipeline")
