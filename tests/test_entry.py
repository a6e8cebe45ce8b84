"""The registered queries without the subpackage for training text."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(q for m in e.LIBRARY for q in m.QUERIES))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_lists_the_library_without_the_subpackage(tmp_path, pipeline):
    shutil.copytree(ROOT / "lodewright", tmp_path / "lodewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py")[: 1 + pipeline]:
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    found = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert found.stdout.strip() == "True"
