import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

RUN = """
import sys
{block}
import __spark_entry__ as entry
from wardline.session import local_session
assert not [name for name in entry.queries() if name.startswith("op") or name == "pipeline"]
spark = local_session("bare", "2", partitions=2, memory="2g")
print("rows", entry.queries()["majority_vote"](spark, {sf!r}).count())
"""


def _copy(target: Path, *left_out: str) -> Path:
    ignore = shutil.ignore_patterns(".git", "__pycache__", "*.json", "*.txt", *left_out)
    return Path(shutil.copytree(ROOT, target / "repo", ignore=ignore))


def _run(repo: Path, block: str = "") -> str:
    path = os.pathsep.join(p for p in sys.path if p and Path(p).resolve() != ROOT)
    result = subprocess.run(
        [sys.executable, "-c", RUN.format(block=block, sf=SF_DIR)], cwd=repo, env=os.environ | {"PYTHONPATH": path},
        capture_output=True, text=True, timeout=300,
    )
    assert result.returncode == 0, result.stderr[-2000:]
    return result.stdout


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")
@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py"), ("corpus_pipeline.py", "queries.py")])
def test_the_entry_works_without_the_training_data_operators(tmp_path, left_out):
    assert "rows" in _run(_copy(tmp_path, *left_out))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")
def test_the_entry_works_without_a_library_that_only_they_use(tmp_path):
    assert "rows" in _run(_copy(tmp_path), "sys.modules['zstandard'] = None")
