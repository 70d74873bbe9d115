"""The library works when the subpackage for text corpora is not there."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_subpackage(tmp_path):
    shutil.copytree(f"{ROOT}/winnow", tmp_path / "winnow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = (
        "import __spark_entry__ as e\n"
        "q, o = e.queries(), e.oracle_sql()\n"
        "assert len(q) > 100 and set(o) <= set(q)\n"
        "assert not [n for n in q if n == 'pipeline' or n.startswith('op')]\n"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, check=True, timeout=120)
