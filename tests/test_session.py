"""Session defaults never override a deployment's own settings."""

import os
import subprocess
import sys

SNIPPET = """
from pyspark.sql import SparkSession
s = (SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')
     .config('spark.sql.autoBroadcastJoinThreshold', '1234').getOrCreate())
from cohortkit.session import configure
configure(s)
print(s.conf.get('spark.sql.autoBroadcastJoinThreshold'), s.conf.get('spark.sql.session.timeZone'),
      s.conf.get('spark.sql.adaptive.autoBroadcastJoinThreshold'))
s.stop()
"""


def test_deployment_settings_win():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", SNIPPET], capture_output=True, text=True, cwd=root, timeout=180,
                         env={**os.environ, "PYTHONPATH": root})
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.split()[-3:] == ["1234", "UTC", str(32 * 1024 * 1024)]
