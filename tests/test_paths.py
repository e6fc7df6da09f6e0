import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

RUN = """
from pathlib import Path
from tripfold.session import local_session
from tripfold.sources import paths

spark = local_session(1, "scratch", **{"spark.checkpoint.dir": "%s"})
folders = [paths.scratch_root(spark) for _ in range(3)]
for f in folders[:2]:
    spark.range(3).write.parquet(f + "/table")
assert all(f.startswith("%s/tripfold-") for f in folders)
assert paths.remove_scratch(spark) == 3 and not any(Path(f).exists() for f in folders)
assert paths.remove_scratch(spark) == 0
kept = paths.scratch_root(spark)
spark.range(1).write.parquet(kept + "/table")
assert paths.create_file(spark, kept + "/a", "one") and not paths.create_file(spark, kept + "/a", "two")
assert paths.read_file(spark, kept + "/a") == "one" and paths.file_names(spark, kept) == ["a"]
paths.rename(spark, kept + "/table", kept + "/deep/moved")
assert spark.read.parquet(kept + "/deep/moved").count() == 1
"""


def test_scratch_folders_and_small_files(tmp_path):
    done = subprocess.run([sys.executable, "-c", RUN % (tmp_path, tmp_path)], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
