"""The whole tree of tests, sub-folders included, must be collected in one run."""

import subprocess
import sys
from pathlib import Path

TESTS = Path(__file__).parent


def test_every_module_is_collected():
    command = [sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider"]
    run = subprocess.run([*command, str(TESTS)], capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stdout[-2000:]
    for module in TESTS.rglob("test_*.py"):
        assert module.name in run.stdout
