"""The entry point without the training-data part's dependencies."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_stands_without_an_optional_dependency(tmpdir_path):
    """An absent third-party module of the optional part leaves the other queries."""
    with open(tmpdir_path + "/xxhash.py", "w") as f:
        f.write("raise ModuleNotFoundError('no xxhash here', name='xxhash')\n")
    code = "import __spark_entry__ as E; q = E.queries(); assert 'quick_profile' in q and len(q) > 50; E.oracle_sql()"
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, check=True, timeout=120,
                   env={**os.environ, "PYTHONPATH": tmpdir_path})
