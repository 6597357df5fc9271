"""The entry module works without the optional parts."""

import subprocess
import sys

from tests.conftest import ROOT

CODE = """
import sys

class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("pulsehouse.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

if %r:
    sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
q, sql = e.queries(), e.oracle_sql()
assert set(sql) <= set(q) and "pv_by_category_30m" in q
print("op10_jaccard_join" in q, "pipeline" in q, len(q))
"""


def _names(gone: bool) -> list[str]:
    out = subprocess.run([sys.executable, "-c", CODE % gone], cwd=ROOT, check=True,
                         capture_output=True, text=True)
    return out.stdout.split()


def test_queries_without_the_optional_operators():
    assert _names(True)[:2] == ["False", "False"]
