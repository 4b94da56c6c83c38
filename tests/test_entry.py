"""A copy without the training-data operators still imports and keeps its other queries."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; print(sum(not n.startswith('op') and n != 'pipeline' for n in e.queries()), sum(n.startswith('op') for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


@pytest.mark.parametrize("without", [["promolens/llm"], ["promolens/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_import_without_the_operators(tmp_path, without):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__", ".pytest_cache") or str((Path(folder) / n).relative_to(ROOT)) in without])
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, timeout=120, check=True).stdout.split()
    assert int(out[-3]) > 200 and (int(out[-2]) > 0) == ("promolens/llm" not in without) and out[-1] == "True"


def test_other_import_errors_are_raised(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    (copy / "corpus_pipeline.py").write_text("import no_such_module\n")
    assert "no_such_module" in subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, timeout=120).stderr
