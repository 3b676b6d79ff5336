"""The entry file where parts of the repository are absent."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from tessera import plans

ROOT = Path(__file__).resolve().parents[1]
SAYS = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


def counts(root: Path, says: str = SAYS) -> list[int]:
    done = subprocess.run(
        [sys.executable, "-W", "ignore", "-c", says], cwd=root, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
    return [int(n) for n in done.stdout.split()]


@pytest.fixture
def copy(tmp_path):
    """A copy of the library and its entry files."""
    skipped = shutil.ignore_patterns("__pycache__")
    shutil.copytree(ROOT / "tessera", tmp_path / "tessera", ignore=skipped)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    return tmp_path


def own() -> list[int]:
    return [len(plans.queries()), len(plans.oracle_sql())]


def test_without_llm_but_with_the_pipeline(copy):
    shutil.rmtree(copy / "tessera" / "llm", ignore_errors=True)
    assert counts(copy) == own()


def test_without_both(copy):
    shutil.rmtree(copy / "tessera" / "llm", ignore_errors=True)
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    assert counts(copy) == own()


def test_with_an_empty_llm_folder(copy):
    shutil.rmtree(copy / "tessera" / "llm", ignore_errors=True)
    (copy / "tessera" / "llm").mkdir()
    assert counts(copy) == own()


def test_without_a_library_that_only_llm_needs(copy):
    says = "import sys; sys.modules['public_tokenizers'] = None; " + SAYS
    assert counts(copy, says) == own()
