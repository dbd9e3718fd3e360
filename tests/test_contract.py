"""The driver contract: bench names, entry module functions."""

import inspect
import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import bench
from refinery.plans import catalog


def test_bench_headline_queries_are_registered():
    queries = entry.queries()
    assert set(bench.HEADLINE) <= set(queries)
    assert "layer_run" in queries


def test_entry_functions_and_signatures():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for name, fn in entry.queries().items():
        assert callable(fn), name
        assert len(inspect.signature(fn).parameters) == 2, name      # (spark, sf_dir)
    assert all(isinstance(sql, str) and sql.strip() for sql in entry.oracle_sql().values())


@pytest.mark.parametrize("blocked", ["zstandard", "refinery.llm", "corpus_pipeline"])
def test_library_queries_do_not_need_the_optional_parts(blocked):
    """With a dependency of the training-data operators, or the operators
    themselves, out of reach, every library query is still registered."""
    code = (f"import sys; sys.modules[{blocked!r}] = None\nimport warnings; warnings.simplefilter('ignore')\n"
            "import __spark_entry__ as e\nprint(sorted(e.queries()) == sorted(e.catalog.QUERIES), len(e.oracle_sql()))")
    root = os.path.dirname(os.path.abspath(entry.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert out.stdout.split() == ["True", str(len(catalog.ORACLE))]
