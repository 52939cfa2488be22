"""Folders whose content changes all at once, or not at all.

A versioned folder holds one folder for each version and a log of entries.  A save writes a new
version beside the others, wherever that data comes from, and then adds one small entry that
names it.  The entry with the highest number is the current version.  Readers look it up first,
so a save that fails half-way changes nothing they can see, and a save may read what it
replaces.  Nothing is renamed and no folder is listed for its data, so this holds for file
systems and for object stores.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LOG = "_versions"
#: Versions that stay when a new one is published: readers of the last one may still run.
KEEP = 2
#: Hours after which a folder that no entry names counts as left over from a failed save.
STALE_HOURS = 48


@dataclass(frozen=True)
class Version:
    """One entry: its number, the folder it names, and what its writer noted."""

    number: int
    folder: str
    notes: Mapping[str, str]


class VersionedFolder:
    """The versions under ``root``, in whatever store it lies."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._store = self._path(self.root).getFileSystem(conf)

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _listed(self, folder: str) -> list:
        path = self._path(folder)
        return list(self._store.listStatus(path)) if self._store.exists(path) else []

    def _read(self, name: str) -> dict | None:
        """An entry, or nothing if its writer ended before it was whole."""
        stream = self._store.open(self._path(f"{self.root}/{LOG}/{name}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def versions(self) -> list[Version]:
        """All whole entries, oldest first."""
        found = []
        for name in sorted(s.getPath().getName() for s in self._listed(f"{self.root}/{LOG}")):
            number, dot, kind = name.partition(".")
            entry = self._read(name) if kind == "json" and number.isdigit() else None
            if entry is not None:
                found.append(Version(int(number), f"{self.root}/{entry['folder']}", entry["notes"]))
        return found

    def current(self) -> Version | None:
        return max(self.versions(), key=lambda v: v.number, default=None)

    def new_folder(self) -> str:
        """A folder for the next version; nobody reads it until it is published."""
        return f"{self.root}/v-{uuid.uuid4().hex}"

    def publish(self, folder: str, notes: Mapping[str, str] | None = None) -> Version:
        """Make a finished folder the current version; the later of two savers wins."""
        name = folder.removeprefix(f"{self.root}/")
        text = json.dumps({"folder": name, "notes": dict(notes or {})}, sort_keys=True)
        taken = (s.getPath().getName().split(".")[0] for s in self._listed(f"{self.root}/{LOG}"))
        number = max((int(n) for n in taken if n.isdigit()), default=0) + 1
        while not self._claim(f"{self.root}/{LOG}/{number:010d}.json", text):
            number += 1
        return Version(number, folder, dict(notes or {}))

    def _claim(self, path: str, text: str) -> bool:
        """Write an entry unless another saver took its number."""
        try:
            out = self._store.create(self._path(path), False)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        return True

    def drop(self, folder: str) -> None:
        self._store.delete(self._path(folder), True)

    def clean(self, keep: int = KEEP, stale_hours: float = STALE_HOURS) -> list[str]:
        """Remove versions before the last ``keep`` and what failed saves left behind."""
        versions = self.versions()
        dead = [v.folder for v in versions[:-keep]] if keep else []
        named = {v.folder for v in versions}
        before = (time.time() - 3600 * stale_hours) * 1000
        for status in self._listed(self.root):
            name = status.getPath().getName()
            old = name.startswith("v-") and status.getModificationTime() < before
            if old and f"{self.root}/{name}" not in named:
                dead.append(f"{self.root}/{name}")
        gone = {v.folder: v.number for v in versions}
        for folder in dead:
            # The entry goes first, so that none names a folder that is gone.
            if folder in gone:
                self.drop(f"{self.root}/{LOG}/{gone[folder]:010d}.json")
            self.drop(folder)
        return dead


def resolve(spark: SparkSession, path: str) -> str:
    """The folder to read: the current version of a versioned folder, else the path itself."""
    current = VersionedFolder(spark, path).current()
    return current.folder if current else path
