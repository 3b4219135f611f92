"""Where intermediate tables lie, and that nothing is left of them."""

import os
import subprocess
import sys

from stockcast import session

PROGRAM = """
import os, sys
from stockcast.session import build_session, materialize, run, run_folder
spark = build_session("plain", "local[1]", **{"spark.ui.enabled": "false"})
assert spark.conf.get("spark.checkpoint.dir", None) is None
with run(spark):
    assert materialize(spark.range(5)).count() == 5
    folder = run_folder(spark)
    assert os.path.isdir(folder)
assert not os.path.exists(folder)
print("FOLDER", materialize(spark.range(3)).inputFiles()[0].removeprefix("file://"))
spark.stop()
"""


def test_a_stock_local_session_keeps_and_removes_its_tables(tmp_path):
    """Without any Spark defaults: an empty configuration folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", PROGRAM], env=environment, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    folder = next(line for line in done.stdout.splitlines() if line.startswith("FOLDER")).split()[1]
    assert "stockcast-" in folder and not os.path.exists(os.path.dirname(os.path.dirname(folder)))


def test_a_run_removes_its_tables(spark):
    with session.run(spark):
        written = session.materialize(spark.range(4))
        folder = session.run_folder(spark)
        assert written.count() == 4 and os.listdir(folder)
    assert not os.path.exists(folder)
