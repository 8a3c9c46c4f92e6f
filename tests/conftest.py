from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import pytest

os.environ["TZ"] = "UTC"
time.tzset()
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakebook.layout import Lake  # noqa: E402
from lakebook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "lakebook-tests")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture
def without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.ansi.enabled")


@pytest.fixture
def land(lake):
    """Write a landed file by hand."""

    def write(subject: str, stamp: str, text: str, ref: str | None = None) -> str:
        folder = Path(lake.landing(subject))
        folder.mkdir(parents=True, exist_ok=True)
        file = folder / f"{subject}_{ref or stamp[:8]}_{stamp}.csv"
        file.write_text(text)
        return str(file)

    return write
