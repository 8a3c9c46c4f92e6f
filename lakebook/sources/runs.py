"""What each run wrote to a table: a small file a run, beside the table's data.

``{table}/_runs/{ts_proc}.json`` names the folders a run filled, the newest file stamp
among its rows, the landed files it read, and its attempts. Readers of the newest run look
it up by listing that one folder of names; they list no other run's files, and the driver
never holds the names of data files. Spark's own readers pass over folders that start with
an underscore, so the table reads as before.

An attempt is one write, told by the identifier that Spark puts into the names of all
files of a write. While a run is being replaced, ``_runs/replacing`` holds its stamp, and
``read_table`` takes of that run only the attempts that its entry names. The entry is
exchanged by one rename: readers see the old attempt before it, and the new one after.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from lakebook.session import hadoop_path

FOLDER = "_runs"
REPLACING = "replacing"
_ENTRY = re.compile(r"(\d{14})\.json")
_ATTEMPT = re.compile(r"^part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")
_LANDED = re.compile(r"([^/]+\.csv)(?:/[^/]*)?$")


@dataclass(frozen=True, order=True)
class LandedFile:
    """A data file of the landing zone; ``stamp`` is the one in its name, if any."""

    path: str
    length: int
    modified: int
    stamp: str | None = None


@dataclass(frozen=True)
class Run:
    """What one run wrote. ``refs`` are partition values; None stands for a missing one."""

    ts_proc: str
    rows: int = 0
    newest: str | None = None
    refs: tuple[str | None, ...] = ()
    attempts: tuple[str, ...] = ()
    files: tuple[LandedFile, ...] = ()
    read_as: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Run:
        held = json.loads(text)
        files = tuple(LandedFile(**f) for f in held.pop("files"))
        return Run(**held | {"files": files, "refs": tuple(held["refs"]), "attempts": tuple(held["attempts"])})


def attempt_of(name: str) -> str | None:
    """The write that a data file's name tells."""
    found = _ATTEMPT.match(name)
    return found[1] if found else None


class RunIndex:
    """The entries of one table."""

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.spark, self.table = spark, table.rstrip("/")
        self.folder = f"{self.table}/{FOLDER}"

    # Files ---------------------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        path, system = hadoop_path(self.spark, folder)
        if not system.exists(path):
            return []
        return [status.getPath().getName() for status in system.listStatus(path) if status.isFile()]

    def _read(self, name: str) -> str | None:
        path, system = hadoop_path(self.spark, name)
        if not system.exists(path):
            return None
        stream = system.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write(self, name: str, text: str) -> None:
        """Put a file in place by a rename that replaces what is there."""
        jvm = self.spark._jvm
        beside = f"{self.folder}/.{uuid.uuid4().hex}"
        path, system = hadoop_path(self.spark, beside)
        stream = system.create(path, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        target, _ = hadoop_path(self.spark, name)
        overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        # The context of the file system at hand; on local disk without checksum files beside.
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            system.makeQualified(target).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        )
        context.rename(system.makeQualified(path), system.makeQualified(target), overwrite)

    def _remove(self, name: str) -> None:
        path, system = hadoop_path(self.spark, name)
        system.delete(path, False)

    # Entries -------------------------------------------------------------------

    def stamps(self) -> list[str]:
        """Run stamps that have an entry, newest first: one listing of names."""
        found = (_ENTRY.fullmatch(name) for name in self._names(self.folder))
        return sorted((match[1] for match in found if match), reverse=True)

    def get(self, ts_proc: str) -> Run | None:
        text = self._read(f"{self.folder}/{ts_proc}.json")
        return None if text is None else Run.from_json(text)

    def newest_first(self) -> Iterator[Run]:
        """Entries from the newest run on, each opened when it is asked for."""
        for ts_proc in self.stamps():
            run = self.get(ts_proc)
            if run is not None:
                yield run

    def newest_file(self) -> Run | None:
        """The run with the newest file; of equals the newest run. Entries are read by tasks."""
        if not self.stamps():
            return None
        found = (
            self.spark.read.schema("ts_proc string, newest string")
            .json(f"{self.folder}/*.json")
            .where("newest is not null")
            .selectExpr("max(struct(newest, ts_proc)) as top")
            .first()["top"]
        )
        return None if found is None else self.get(found["ts_proc"])

    def put(self, run: Run) -> None:
        self._write(f"{self.folder}/{run.ts_proc}.json", run.to_json())

    # Replacing -----------------------------------------------------------------

    def replacing(self) -> list[str]:
        return self._names(f"{self.folder}/{REPLACING}")

    def begin(self, ts_proc: str) -> None:
        """From now on only the attempts that the run's entry names are read."""
        path, system = hadoop_path(self.spark, f"{self.folder}/{REPLACING}")
        system.mkdirs(path)
        self._write(f"{self.folder}/{REPLACING}/{ts_proc}", "")

    def end(self, ts_proc: str) -> None:
        self._remove(f"{self.folder}/{REPLACING}/{ts_proc}")


# Data files of a run -------------------------------------------------------------


def run_files(spark: SparkSession, table: str, ts_proc: str, folders: Sequence[str] = ("ref=*",)) -> list:
    """Statuses of a run's data files, in the given folders of days."""
    found = []
    for folder in folders:
        path, system = hadoop_path(spark, f"{table}/{folder}/ts_proc={ts_proc}/part-*")
        found.extend(system.globStatus(path) or [])
    return found


def landed_files(spark: SparkSession, pattern: str) -> list[LandedFile]:
    """The data files that a path or pattern of the landing zone stands for, none opened."""
    path, system = hadoop_path(spark, pattern)
    statuses, found = list(system.globStatus(path) or []), []
    while statuses:
        status = statuses.pop()
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if status.isDirectory():
            statuses.extend(system.listStatus(status.getPath()))
            continue
        where = status.getPath().toString()
        landed = _LANDED.search(where)
        parts = landed[1].split("_") if landed else []
        stamp = parts[2].removesuffix(".csv") if len(parts) > 2 else None
        found.append(LandedFile(where, status.getLen(), status.getModificationTime(), stamp))
    return sorted(found)
