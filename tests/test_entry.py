"""The driver contract holds without the training-data subpackage."""

import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) <= set(q), any(n.startswith('op') for n in q), 'pipeline' in q)"


def counted(folder) -> list[str]:
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120, check=True)
    return done.stdout.split()


def test_queries_without_the_subpackage(tmp_path):
    from skyweft.plans import registry

    copy = tmp_path / "copy"
    copy.mkdir()
    shutil.copytree(ROOT / "skyweft", copy / "skyweft", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", copy)
    core = [str(len(registry.queries())), "True", "False", "False"]
    assert counted(copy) == core
    if (ROOT / "corpus_pipeline.py").exists():  # left behind, it does not count either
        shutil.copy(ROOT / "corpus_pipeline.py", copy)
        assert counted(copy) == core
    (copy / "skyweft" / "llm" / "__pycache__").mkdir(parents=True)
    assert counted(copy) == core
