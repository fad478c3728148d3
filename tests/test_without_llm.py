"""The entry point of a copy that lacks the corpus folder."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def _names(folder):
    code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=300, check=True)
    return done.stdout.split()


def test_entry_without_the_corpus_folder(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "streetflow", tmp_path / "streetflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    names = _names(tmp_path)
    assert "j1_rerouting_alerts" in names and "pipeline" not in names and not [n for n in names if n.startswith("op")]
