"""The session helpers on a machine whose Spark configuration sets nothing."""

import os
import subprocess
import sys

CODE = """
from webloom.session import checkpoint_dir, get_session
from webloom.operators.common import cut_lineage, scratch_path
spark = get_session(master="local[1]", cpus=1)
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert cut_lineage(spark.range(3)).count() == 3
assert scratch_path(spark, "x").startswith(checkpoint_dir(spark))
print("FINE")
"""


def test_checkpoint_folder_without_any_configuration(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root, "TMPDIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", CODE], env=env, capture_output=True, text=True, timeout=300)
    assert "FINE" in done.stdout, done.stderr[-2000:]
