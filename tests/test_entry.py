import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).parents[1]


def test_entry_runs(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["league", "season", "total", "scored", "with_odds"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_rest_works_without_the_training_data_folder(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'a01_completeness' in q and not any(k.startswith('op') for k in q), q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, check=True)
    # The other tests don't need it either: all can be collected, and some are run.
    tests = [sys.executable, "-B", "-m", "pytest", "-q", "-p", "no:cacheprovider"]
    subprocess.run([*tests, "--collect-only", "tests"], cwd=copy, check=True, stdout=subprocess.DEVNULL)
    subprocess.run([*tests, "tests/test_matching.py"], cwd=copy, check=True, stdout=subprocess.DEVNULL)
