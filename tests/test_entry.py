"""Queries leave the caller's session as it was; only the optional part may be missing."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry_points

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"


def test_no_query_changes_the_session(spark):
    before = dict(spark.conf.getAll)
    for name in ("conform_products", *[n for n in entry_points.queries() if n.startswith("op") or n == "pipeline"][:2]):
        entry_points.queries()[name](spark, SF)
        assert dict(spark.conf.getAll) == before


def run(script):
    return subprocess.run([sys.executable, "-c", script], cwd=ROOT, capture_output=True, text=True, timeout=120)


def blocked(name):
    return (
        "import sys\nclass Block:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        f"        if name == {name!r}:\n            raise ModuleNotFoundError(f'No module named {{name!r}}', name=name)\n"
        "sys.meta_path.insert(0, Block())\nimport __spark_entry__ as e\n"
        "print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())\n"
    )


def test_the_optional_part_may_be_missing():
    found = run(blocked("lakebook.llm"))
    assert found.stdout.split() == ["45", "45", "False"], found.stderr


def test_a_missing_library_is_not_hidden():
    if not (ROOT / "lakebook" / "llm").is_dir():
        return
    found = run(blocked("numpy"))
    assert found.returncode != 0 and "numpy" in found.stderr
