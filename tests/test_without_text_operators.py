"""The rest of the package without the text operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import __spark_entry__ as e
from stayflow.catalog.oracle import ORACLE
from stayflow.catalog.queries import REGISTRY
assert set(e.queries()) == set(REGISTRY) and set(e.oracle_sql()) == set(ORACLE) <= set(REGISTRY)
print(len(REGISTRY))
"""


def test_a_copy_without_their_folders_registers_the_other_queries(tmp_path):
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(ROOT / "stayflow", copy / "stayflow", ignore=left_out)
    for kept in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / kept).exists():
            shutil.copy(ROOT / kept, copy)
    run = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) >= 83
