import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SF_DIR = "/root/testdata/sf0.001"

RUN = f"""
import __spark_entry__ as e
from tripfold.session import local_session
names = set(e.queries())
assert "kpi_daily" in names and not any(n == "pipeline" or n.startswith("op") and n[2].isdigit() for n in names), names
assert set(e.oracle_sql()) <= names
spark = local_session(2, "bare")
assert e.queries()["kpi_daily"](spark, "{SF_DIR}").count() > 0
"""


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no generated tables here")
@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_llm_folders(tmp_path, pipeline):
    """The rest imports and answers where tripfold/llm is gone, with or without corpus_pipeline.py."""
    shutil.copytree(ROOT / "tripfold", tmp_path / "tripfold", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py") if pipeline else ("__spark_entry__.py",):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    env = os.environ | {"PYTHONPATH": os.environ.get("PYTHONPATH", "").replace(str(ROOT), "")}
    done = subprocess.run([sys.executable, "-c", RUN], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
