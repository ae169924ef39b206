"""Versioned manifests: which files or folders make up a table, replaced as a whole.

A version is one small JSON file. It is written under another name and renamed, so that readers see it whole or not at all;
what it does not name is not part of the table. One writer at a time, any number of readers.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession

FOLDER = "_manifest"
#: Versions kept, so that a reader of the one before the last still finds its files.
KEEP = 2


class Manifest:
    """Entries (small dictionaries) of the table at ``root``, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *names: str):
        return self._path("/".join([self.root, *names]))

    def _names(self, *folder: str) -> list[str]:
        where = self._at(*folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names(FOLDER) if n.endswith(".json") and n[0].isdigit()]

    def read(self, version: int) -> list[dict[str, Any]]:
        stream = self._fs.open(self._at(FOLDER, f"{version:020d}.json"))
        try:
            return json.loads(self._io.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, list[dict[str, Any]]]:
        """The last version and its entries; (0, []) before the first."""
        known = self.versions()
        return (known[-1], self.read(known[-1])) if known else (0, [])

    def commit(self, version: int, entries: list[dict[str, Any]]) -> None:
        """Make ``entries`` the given version, which must be new."""
        final, draft = self._at(FOLDER, f"{version:020d}.json"), self._at(FOLDER, f".{uuid.uuid4().hex}")
        if self._fs.exists(final):
            raise ValueError(f"version {version} of {self.root} exists: another writer is at work")
        stream = self._fs.create(draft, False)
        try:
            self._io.write(json.dumps(entries), stream, "UTF-8")
        finally:
            stream.close()
        if not self._fs.rename(draft, final):
            raise ValueError(f"version {version} of {self.root} could not be committed")

    def vacuum(self, prefix: str = "part-", field: str = "path") -> None:
        """Remove old versions, and folders called ``prefix``... that none of the kept versions names."""
        known = self.versions()
        kept = known[-KEEP:]
        named = {e[field] for v in kept for e in self.read(v)}
        for v in known[:-KEEP]:
            self._fs.delete(self._at(FOLDER, f"{v:020d}.json"), False)
        for name in self._names():
            if name.startswith(prefix) and name not in named:
                self._fs.delete(self._at(name), True)

    def move(self, source: str, target: str, modified: int | None = None) -> bool:
        """Move a file, unless it is gone or, given its time in milliseconds, has changed; a file at the target stays, the
        moved one then gets its time as a suffix."""
        here, there = self._path(source), self._path(target)
        if not self._fs.exists(here):
            return False
        at = self._fs.getFileStatus(here).getModificationTime()
        if modified is not None and at != modified:
            return False
        if self._fs.exists(there):
            there = self._path(f"{target}.{at}")
        self._fs.mkdirs(there.getParent())
        return bool(self._fs.rename(here, there))
