"""The driver contract holds without the text operators, too."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_text_operators(tmp_path):
    skip = shutil.ignore_patterns("llm", "__pycache__", ".git", "*.json", "*.md", "*.txt")
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    code = ("import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q) and 'listing_features' in q; "
            "print(sorted(n for n in q if n.startswith('op') or n == 'pipeline'))")
    for gone in ([], ["corpus_pipeline.py"]):
        for name in gone:
            os.remove(tmp_path / "copy" / name)
        run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
        assert run.returncode == 0, run.stderr
        assert run.stdout.strip().splitlines()[-1] == "[]"
