from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
LISTING = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


def test_the_rest_stands_without_the_addition(tmp_path):
    """The archive's queries are there when the folders of the other operators are not, with or without the pipeline."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    for left_out in (None, "corpus_pipeline.py"):
        if left_out:
            (copy / left_out).unlink(missing_ok=True)
        # the driver's path only: the package next to the entry file is the one found
        environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        run = subprocess.run(
            [sys.executable, "-c", LISTING], cwd=copy, env=environment, capture_output=True, text=True, timeout=120
        )
        assert run.returncode == 0, run.stderr
        found, with_sql, has_pipeline = run.stdout.split()
        assert int(found) > 50 and int(with_sql) > 50 and has_pipeline == "False"
