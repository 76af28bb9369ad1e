import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]


def test_every_query_has_its_name_and_sql():
    found, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert len(found) >= 50 and set(sql) <= set(found)


def test_rest_stands_without_the_subpackage(tmp_path):
    for x in ("__spark_entry__.py", "orchardflow"):
        (shutil.copytree if (ROOT / x).is_dir() else shutil.copy)(ROOT / x, tmp_path / x)
    shutil.rmtree(tmp_path / "orchardflow" / "llm", ignore_errors=True)
    says = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op1') or k == 'pipeline' for k in e.queries()))"], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert says.returncode == 0 and says.stdout.split()[-1] == "False" and int(says.stdout.split()[0]) >= 50, says.stderr


def test_flagship(spark):
    if Path("/root/testdata/sf0.001").exists():
        assert __spark_entry__.entry(spark).count() > 0
