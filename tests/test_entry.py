"""Entry points without the training-data subpackage, or without a library that only it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

TOP = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("gone", ["tiktoken", "tokenizers", "tidemark.llm", "corpus_pipeline"])
def test_other_queries_stay(gone):
    code = f"import sys; sys.modules[{gone!r}] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op1') for n in q), set(e.oracle_sql()) <= set(q))"
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=TOP, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 130 and out[1:] == ["False", "True"]
