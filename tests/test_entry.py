"""The driver's contract holds with and without the operators of the training-data pipeline."""

import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = "import __spark_entry__ as e, json; print(json.dumps([e.__file__, sorted(e.queries()), sorted(e.oracle_sql())]))"


def entry_of(folder, path):
    environment = {**os.environ, "PYTHONPATH": os.pathsep.join(map(str, path))}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=folder, env=environment, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    where, queries, oracles = json.loads(done.stdout)
    assert Path(where).parent == folder
    return queries, oracles


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
@pytest.mark.parametrize("others", [[], [ROOT]])
def test_entry_without_the_pipeline(tmp_path, left_out, others):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(*left_out, ".git", "__pycache__"))
    queries, oracles = entry_of(copy, [copy, *others])
    assert queries == oracles and len(queries) > 60
    assert not [name for name in queries if name.startswith("op") or name == "pipeline"]
    if (ROOT / "gridzonal" / "llm").exists():
        more = set(entry_of(ROOT, [ROOT])[0]) - set(queries)
        assert "pipeline" in more and all(name.startswith("op") or name == "pipeline" for name in more)
