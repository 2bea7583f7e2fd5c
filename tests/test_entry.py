"""The entry without its optional parts."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_optional_subpackage(tmp_path):
    shutil.copytree(os.path.join(ROOT, "touchline"), tmp_path / "touchline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') and n[2].isdigit() for n in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= 75 and int(out[1]) >= 71 and out[2] == "False"


def test_a_missing_script_takes_only_its_own_query(tmp_path):
    if not os.path.isdir(os.path.join(ROOT, "touchline", "llm")):
        return
    shutil.copytree(os.path.join(ROOT, "touchline"), tmp_path / "touchline", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; print(sum(n.startswith('op') and n[2].isdigit() for n in e.queries()), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= 10 and out[1] == "False"
