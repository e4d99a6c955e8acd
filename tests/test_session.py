"""The session's scratch folders."""

import os
import subprocess
import sys

from tests.conftest import ROOT

APP = """
import sys
from weir.session import build_session, scratch_path
spark = build_session("local[2]", 2, extra={"spark.checkpoint.dir": sys.argv[1]})
a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
assert a != b and a.startswith(sys.argv[1])
spark.range(10).write.parquet(a)
assert spark.read.parquet(a).count() == 10
open(sys.argv[1] + "/seen", "w").write(a)
"""


def test_scratch_folders_go_with_the_application(tmp):
    done = subprocess.run([sys.executable, "-c", APP, tmp], env={**os.environ, "PYTHONPATH": ROOT}, capture_output=True,
                          text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    with open(f"{tmp}/seen") as f:
        written = f.read()
    assert not os.path.exists(written) and not os.path.exists(os.path.dirname(written))
