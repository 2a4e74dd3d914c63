import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_without_the_llm_folders(tmp_path):
    """The entry point still imports and lists the other queries."""
    shutil.copytree(f"{REPO}/grafloom", tmp_path / "grafloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "grafloom" / "llm" / "__pycache__").mkdir(parents=True)
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'plants_index' in q and not [x for x in q if x.startswith('op')] and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
