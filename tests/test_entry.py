"""The entry without the training-data subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

HIDDEN = """
import importlib.abc, sys

class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.startswith(HIDE):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

HIDE = %r
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
names = set(e.queries())
assert "mart_daily_usage" in names and "pipeline" not in names, names
assert not any(n.startswith("op") for n in names), names
assert set(e.oracle_sql()) <= names
"""

RUN = """
from ledgerlake.session import build_session
s = build_session("local[2]", app="entry-test", shuffle_partitions=2)
assert e.entry(s).count() > 0
assert e.queries()["mart_tickets_day"](s, "/root/testdata/sf0.001").count() > 0
s.stop()
"""


def _python(code):
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr


def test_entry_without_subpackage():
    _python(HIDDEN % ("ledgerlake.llm",) + RUN)


def test_entry_without_a_library_of_the_subpackage():
    _python(HIDDEN % ("public_tokenizers",))
