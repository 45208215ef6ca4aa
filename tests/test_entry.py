"""The registry without the optional subpackage."""

import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_registry_without_the_optional_subpackage(tmp_path):
    shutil.copytree(ROOT / "wrenfield", tmp_path / "wrenfield", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    said = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'pipeline' not in q and s.keys() <= q.keys(); print(len(q))"
    run = subprocess.run([sys.executable, "-c", said], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) > 100
