"""What is registered, and that the rollups do without the training-data part."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from spintally.checks import queries

REPO = Path(__file__).resolve().parents[1]

BLOCKED = """
import sys
for name in {blocked}:
    sys.modules[name] = None  # importing it raises ImportError
import __spark_entry__
print("\\n".join(sorted(__spark_entry__.queries())))
assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
"""


@pytest.mark.parametrize("blocked", [["regex"], ["xxhash"], ["corpus_pipeline"], ["spintally.llm"]], ids=str)
def test_rollups_are_registered_without_the_rest(blocked):
    done = subprocess.run(
        [sys.executable, "-c", BLOCKED.format(blocked=blocked)], cwd=REPO, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == sorted(queries.queries())
