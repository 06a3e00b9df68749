import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
CHECK = """
import sys
import __spark_entry__ as entry
names = set(entry.queries())
assert 'mart_revenue' in names and set(entry.oracle_sql()) <= names
assert names == set(entry.MODELS), names
assert not any('llm' in m for m in sys.modules if m.startswith('shoplens'))
"""


def test_an_export_without_the_training_data_operators(tmp_path):
    for file in ROOT.glob("*.py"):
        shutil.copy(file, tmp_path)
    shutil.copytree(
        ROOT / "shoplens", tmp_path / "shoplens", ignore=shutil.ignore_patterns("llm", "__pycache__")
    )
    # with the pipeline still there, and without it
    subprocess.run([sys.executable, "-c", CHECK], cwd=tmp_path, check=True, timeout=120)
    (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
    subprocess.run([sys.executable, "-c", CHECK], cwd=tmp_path, check=True, timeout=120)
