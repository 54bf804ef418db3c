import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = "import __spark_entry__ as e; print(sorted(e.queries())); print(sorted(e.oracle_sql()))"


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_all_other_queries_are_registered_from_a_copy_without(left_out, tmp_path):
    ignore = shutil.ignore_patterns("__pycache__", ".git", *left_out)
    for name in ("stemma", "__spark_entry__.py", "corpus_pipeline.py"):
        source = os.path.join(ROOT, name)
        if name in left_out or not os.path.exists(source):
            continue
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=ignore)
        else:
            shutil.copy(source, tmp_path / name)
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    queries, oracles = (eval(line) for line in done.stdout.strip().splitlines()[-2:])
    assert set(oracles) <= set(queries)
    assert "noise_ledger" in queries and "pipeline" not in queries
    if "llm" in left_out:
        assert not any(q.startswith("op") and q[2:3].isdigit() for q in queries)
