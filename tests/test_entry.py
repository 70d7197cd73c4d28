"""The entry without the training-data queries."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("missing", ["claimloom.llm", "ahocorasick", "duckdb"])
def test_other_queries_stay(missing):
    """Neither the subpackage nor a library that only it needs is needed by the others."""
    code = (
        f"import sys, warnings; sys.modules[{missing!r}] = None; warnings.simplefilter('ignore')\n"
        "import __spark_entry__ as e\n"
        "from workload.spark_queries import QUERIES\n"
        "assert set(e.queries()) == set(QUERIES) and len(QUERIES) >= 57\n"
        "assert set(e.oracle_sql()) <= set(QUERIES)\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
