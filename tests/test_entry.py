import subprocess
import sys

import __spark_entry__ as entry


def test_registry():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and "hybrid_search" in q


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["query_id", "chunk_id", "rrf", "sim", "place", "matched_by"] and found.count() > 0


def test_without_the_subpackage(tmp_path):
    """The core stands without the optional subpackage; a broken import inside of it is no absence."""
    import shutil
    from pathlib import Path

    root = Path(entry.__file__).parent
    shutil.copytree(root / "tomeflow", tmp_path / "tomeflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    say = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('p1_') for n in e.queries()))"
    run = lambda: subprocess.run([sys.executable, "-c", say], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert run().stdout.split()[1] == "False"
    (tmp_path / "tomeflow/llm").mkdir()
    (tmp_path / "tomeflow/llm/__init__.py").write_text("")
    (tmp_path / "tomeflow/llm/queries.py").write_text("import no_such_module")
    assert "no_such_module" in run().stderr
