"""The entry works without the corpus operators, whether or not their pipeline file is there."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("with_file", [True, False])
def test_import_without_corpus_operators(tmp_path, with_file):
    left_out = shutil.ignore_patterns("llm", "__pycache__", ".*", *([] if with_file else ["corpus_pipeline.py"]))
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=left_out)
    code = (
        "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); "
        "assert 'features_all' in q and set(s) <= set(q); "
        "assert 'pipeline' not in q and not any(n.startswith('op1_') for n in q)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)
    subprocess.run([sys.executable, "-c", "import compare"], cwd=copy / "tools", check=True)
