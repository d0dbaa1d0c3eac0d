"""The contract without the corpus operators' libraries."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
BLOCKED = """
import sys
sys.modules[sys.argv[1]] = None  # importing it fails
import __spark_entry__ as contract
print(len(contract.queries()), len(contract.oracle_sql()))
"""


@pytest.mark.parametrize("module", ["public_tokenizers", "corpus_pipeline", "wardbook.llm", "tokenizers_that_nobody_needs"])
def test_other_queries_work_without_corpus_libraries(module):
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", BLOCKED, module], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    n, oracles = map(int, done.stdout.split())
    import wardbook.queries as registered

    alone = len(registered.queries())
    assert n >= alone and oracles >= alone
    if module != "tokenizers_that_nobody_needs":
        assert n == alone == oracles
