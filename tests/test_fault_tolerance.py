import os
import subprocess
import sys

from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_results_survive_task_retries():
    script = os.path.join(ROOT, "tests", "scripts", "task_retry_check.py")
    done = subprocess.run([sys.executable, script, ROOT, SF_SMALL], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "task-retry checks passed" in done.stdout
