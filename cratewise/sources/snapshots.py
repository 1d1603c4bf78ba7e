"""Snapshots: sets of tables that readers see whole or not at all.

A set is written to a folder of its own below ``data``. What makes it visible is one small manifest below
``_snapshots``: numbered, written beside and renamed into its place last, and never changed afterwards.
Readers take the manifest of the highest number and find every table through it, so they see the set
before or the set after a commit, whatever happens to the job in between. Two jobs that commit at once
take different numbers: the rename fails where the number is taken, and the later one builds on the other.

The file system must rename files atomically, as HDFS and local disks do.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# A manifest's name; twelve digits sort like their numbers.
_MANIFEST = re.compile(r"(\d{12})\.json")


@dataclass(frozen=True)
class Snapshot:
    """What one manifest says: for every dump version (empty without one) the folder of each table."""

    number: int
    versions: dict[str, dict[str, str]]

    def folders(self) -> set[str]:
        """The written sets it refers to, below ``data``."""
        return {path.split("/")[1] for tables in self.versions.values() for path in tables.values()}


class SnapshotStore:
    """The snapshots below one folder, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        conf = spark._jsc.hadoopConfiguration()
        place = self._hadoop.Path(self.root)
        self._files = place.getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(self._files.getUri(), conf)

    def _path(self, *parts: str) -> object:
        return self._files.makeQualified(self._hadoop.Path("/".join([self.root, *parts])))

    def _numbers(self) -> list[int]:
        folder = self._path("_snapshots")
        if not self._files.exists(folder):
            return []
        found = [_MANIFEST.fullmatch(status.getPath().getName()) for status in self._files.listStatus(folder)]
        return sorted(int(match[1]) for match in found if match)

    def read(self, number: int) -> Snapshot:
        stream = self._files.open(self._path("_snapshots", f"{number:012d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Snapshot(number, json.loads(text)["versions"])

    def latest(self) -> Snapshot | None:
        numbers = self._numbers()
        return self.read(numbers[-1]) if numbers else None

    def table_path(self, snapshot: Snapshot | None, name: str, version: str | None = None) -> str:
        """Folder of a table in a snapshot; ``FileNotFoundError`` if the snapshot has none."""
        tables = snapshot.versions.get(version or "", {}) if snapshot else {}
        if name not in tables:
            tag = f" of version {version}" if version else ""
            raise FileNotFoundError(f"{self.root} has no table {name}{tag}")
        return f"{self.root}/{tables[name]}"

    def new_folder(self) -> str:
        """A folder for a set that is about to be written; nothing refers to it before :meth:`commit`."""
        return f"{self.root}/data/{uuid.uuid4().hex}"

    def commit(self, folder: str, names: Iterable[str], version: str | None = None) -> Snapshot:
        """Make the tables ``names``, written below ``folder``, the current set of a version at once."""
        below = folder.removeprefix(f"{self.root}/")
        tables = {name: f"{below}/{name}" for name in sorted(names)}
        while True:
            before = self.latest()
            number = before.number + 1 if before else 1
            versions = {**(before.versions if before else {}), version or "": tables}
            beside = f".{uuid.uuid4().hex}.json"
            self._write(json.dumps({"versions": versions}, indent=1, sort_keys=True), "_snapshots", beside)
            if self._rename(("_snapshots", beside), ("_snapshots", f"{number:012d}.json")):
                return Snapshot(number, versions)
            self._delete("_snapshots", beside)

    def discard(self, folder: str) -> None:
        """Remove a set that was not committed."""
        self._delete(folder.removeprefix(f"{self.root}/"))

    def expire(self, keep: int) -> list[str]:
        """Remove the data that none of the last ``keep`` snapshots refers to, then the older manifests.

        Sets of jobs that are still writing stand in no manifest and are left alone. Data goes first: a
        manifest that outlives its data is never the highest one, and the next call removes it.
        """
        if keep < 1:
            raise ValueError("the current snapshot must stay")
        numbers = self._numbers()
        old, current = numbers[:-keep], numbers[-keep:]
        used = set().union(*[self.read(n).folders() for n in current])
        gone = sorted(set().union(*[self.read(n).folders() for n in old]) - used)
        for folder in gone:
            self._delete("data", folder)
        for number in old:
            self._delete("_snapshots", f"{number:012d}.json")
        return gone

    def remove_orphans(self, older_than_hours: float = 72) -> list[str]:
        """Remove sets that no manifest refers to and that were begun so long ago: those of killed jobs."""
        folder = self._path("data")
        if not self._files.exists(folder):
            return []
        before = (time.time() - 3600 * older_than_hours) * 1000
        # Listed before the manifests are read: a set that is committed meanwhile is found there.
        written = {s.getPath().getName(): s.getModificationTime() for s in self._files.listStatus(folder)}
        used = set().union(*[self.read(n).folders() for n in self._numbers()])
        gone = sorted(name for name, at in written.items() if name not in used and at < before)
        for name in gone:
            self._delete("data", name)
        return gone

    def _write(self, text: str, *parts: str) -> None:
        stream = self._files.create(self._path(*parts), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def _rename(self, source: tuple[str, ...], target: tuple[str, ...]) -> bool:
        """Rename a file; False if the target is there already."""
        kind = getattr(self._hadoop, "Options$Rename")
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            self._context.rename(self._path(*source), self._path(*target), options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def _delete(self, *parts: str) -> None:
        self._files.delete(self._path(*parts), True)
