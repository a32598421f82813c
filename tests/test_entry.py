"""The entry works with and without the training-text folder."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("ledgerspark.llm"):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Hidden())
"""


def names(before: str) -> set[str]:
    code = before + "import __spark_entry__ as e\nprint(*e.queries())\nassert set(e.oracle_sql()) <= set(e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return set(out.stdout.split())


def test_queries_without_the_folder():
    assert "cascade_totals" in names(HIDE)
    assert not [n for n in names(HIDE) if n.startswith("op") and n[2:3].isdigit()]


def test_nothing_else_imports_the_folder():
    for file in (ROOT / "ledgerspark").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert "ledgerspark.llm" not in file.read_text(), file
