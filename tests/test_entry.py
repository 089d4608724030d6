"""The entry without the training-data subpackage."""

import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') and n[2].isdigit() for n in e.queries()))"


@pytest.mark.parametrize("leave_folder", [False, True])
def test_entry_without_the_subpackage(tmp_path, leave_folder):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "tradeloom", tmp_path / "tradeloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    if leave_folder:
        (tmp_path / "tradeloom" / "llm" / "__pycache__").mkdir(parents=True)
    done = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    jobs, texts, numbered = done.stdout.split()
    assert int(jobs) == int(texts) > 80 and numbered == "False"
