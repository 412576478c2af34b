"""The core works without the optional training-text part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
ASK = """
import sys
import __spark_entry__ as contract
from newspipe.plans.queries import REGISTRY
assert "newspipe.llm" not in sys.modules
assert set(contract.queries()) == set(REGISTRY)
assert set(contract.oracle_sql()) == set(REGISTRY)
"""


@pytest.mark.parametrize("gone", [("corpus_pipeline.py",), ()])
def test_import_and_collect_without_it(tmp_path, gone):
    left_out = shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", *gone)
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=left_out)
    for command in (["-c", ASK], ["-m", "pytest", "tests", "--collect-only", "-q"]):
        done = subprocess.run([sys.executable, *command], cwd=copy, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stdout + done.stderr
