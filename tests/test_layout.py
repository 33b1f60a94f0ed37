import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_rest_works_without_the_training_data_operators(tmp_path):
    shutil.copytree(os.path.join(ROOT, "ledgerwatch"), tmp_path / "ledgerwatch", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and 'pipeline' not in q and not any(k[:2] == 'op' for k in q); assert e.oracle_sql().keys() <= q.keys()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(tmp_path)})


def test_a_missing_package_leaves_the_rest(tmp_path):
    """The folder is there, but what it imports is not."""
    shutil.copytree(os.path.join(ROOT, "ledgerwatch"), tmp_path / "ledgerwatch", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "ledgerwatch" / "llm").mkdir()
    (tmp_path / "ledgerwatch" / "llm" / "__init__.py").touch()
    (tmp_path / "ledgerwatch" / "llm" / "registry.py").write_text("import a_package_that_nobody_has\n")
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 90 and not any(k[:2] == 'op' for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(tmp_path)})
