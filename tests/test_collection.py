"""The whole tree can be collected, with and without the corpus folders."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("left_out", [(), ("storelens/llm", "tests/llm", "corpus_pipeline.py")])
def test_all_modules_are_collected(tmp_path, left_out):
    copy = tmp_path / "repo"
    gone = {ROOT / name for name in left_out}
    shutil.copytree(
        ROOT, copy, ignore=lambda folder, names: [n for n in names if n in {".git", "__pycache__"} or Path(folder, n) in gone])
    run = subprocess.run(
        [sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests"],
        cwd=copy, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stdout[-3000:] + run.stderr[-3000:]
    for module in (copy / "tests").rglob("test_*.py"):
        assert f"{module.relative_to(copy)}::" in run.stdout
