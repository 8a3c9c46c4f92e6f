"""Where the lake's tables live, and the stamps that name files and batches."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime

# Zone folders, table folders and ledger subjects of the lake.
LANDING_ZONE = "0000_ingestion"
RAW_ZONE = "0001_raw"
CURATED_ZONE = "0002_curated"
CONTROL_ZONE = "0003_controle"
BOOK_TABLE = "book_1_fraude"
BOOK_CONTROL = "book/book_1_fraude"
BOOK_SUBJECT = "Book_1_Fraude"
SUBJECTS = ("products", "sales", "users")

DAY_FORMAT = "%Y%m%d"
STAMP_FORMAT = "%Y%m%d%H%M%S"
_STAMP = re.compile(r"\d{14}")


def day(value: date) -> str:
    """``yyyyMMdd``, the form of every ``ref``."""
    return value.strftime(DAY_FORMAT)


def stamp(value: datetime) -> str:
    """``yyyyMMddHHmmss``, the form of ``ts_proc`` and ``ts_file_generation``."""
    return value.strftime(STAMP_FORMAT)


def checked_stamp(value: str) -> str:
    """Refuse a run stamp that is not 14 digits.

    Batches are ordered by comparing stamps as text, which is only
    chronological while all of them have the same width.
    """
    if not _STAMP.fullmatch(value):
        raise ValueError(f"a run stamp needs 14 digits (yyyyMMddHHmmss), got {value!r}")
    return value


@dataclass(frozen=True)
class Lake:
    """Paths below one root folder or object-store prefix."""

    root: str

    def _zone(self, zone: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{zone}/{table}"

    def landing(self, subject: str) -> str:
        return self._zone(LANDING_ZONE, subject)

    def landing_file(self, subject: str, ref: str, generated: str) -> str:
        return f"{self.landing(subject)}/{subject}_{ref}_{generated}.csv"

    def landing_glob(self, subject: str) -> str:
        return f"{self.landing(subject)}/*.csv"

    def raw(self, subject: str) -> str:
        return self._zone(RAW_ZONE, subject)

    def raw_increment(self, subject: str) -> str:
        return self._zone(RAW_ZONE, f"{subject}_increment")

    def curated(self, table: str = BOOK_TABLE) -> str:
        return self._zone(CURATED_ZONE, table)

    def control(self, table: str) -> str:
        return self._zone(CONTROL_ZONE, table)
