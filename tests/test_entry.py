"""The entry without the corpus part, or without a library that only it needs."""

import subprocess
import sys

from tests.conftest import ROOT


def names(prelude: str) -> set[str]:
    code = prelude + "\nimport __spark_entry__ as e; print(' '.join(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True)
    return set(out.stdout.split())


def test_table_queries_stand_without_the_corpus_part_or_its_libraries():
    from strata.registry import QUERIES
    for gone in ("strata.llm", "corpus_pipeline", "ahocorasick"):
        assert set(QUERIES) <= names(f"import sys; sys.modules[{gone!r}] = None")
        assert not any(q.startswith("op1_") for q in names(f"import sys; sys.modules[{gone!r}] = None"))
