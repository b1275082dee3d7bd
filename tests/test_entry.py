"""The entry module with and without the text-pipeline subpackage."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT

LIST = "import __spark_entry__ as e; print(len(e.queries()), len(set(e.oracle_sql()) - set(e.queries())))"


def test_entry_works_without_the_text_pipeline(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(ROOT, "minewright"), copy / "minewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), copy / name)
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", LIST], cwd=copy, env=environment, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    known, stray = map(int, run.stdout.split())
    assert known >= 90 and stray == 0
