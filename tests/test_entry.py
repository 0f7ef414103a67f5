import subprocess
import sys
from pathlib import Path


def test_names_are_read_without_a_session():
    root = Path(__file__).resolve().parent.parent
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
