"""The driver's entry point, with and without the optional part."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("absent", ["ahocorasick", "corpus_pipeline", "fieldglass.llm"])
def test_entry_works_without_the_optional_part(absent):
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') and q[2].isdigit() for q in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    queries, oracles, optional = out.stdout.split()
    assert int(queries) > int(oracles) > 150 and optional == "False", out.stderr
