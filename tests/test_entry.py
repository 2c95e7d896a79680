"""The driver's contract without a session."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_and_sql_need_no_session():
    """Names and SQL are there before any Spark session is."""
    code = "import __spark_entry__ as E; q, o = E.queries(), E.oracle_sql(); assert set(o) <= set(q) and len(o) > 100"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=300)
