"""The entry module from another folder, where the executors cannot import the package."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from folioworks.session import build_session
spark = build_session("entry", "local[2]", **{{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false"}})
assert entry.entry(spark).count() > 0
assert entry.queries()["page_title"](spark, "/root/testdata/sf0.001").count() > 0
assert set(entry.oracle_sql()) <= set(entry.queries())
"""


def test_entry_from_another_folder(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(repo=str(Path(__file__).resolve().parent.parent)))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
