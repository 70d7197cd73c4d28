"""A journal of refreshes, so that a run that was stopped leaves nothing half done.

A refresh writes its intention before it writes rows, and that it is about to switch before it
switches. A later run reads what is still there and finishes or undoes it. An entry is a small file
for each of the two marks; a mark that was cut off while it was written counts as not made.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

BEGUN, SWITCHING = "begun", "switching"


class Files:
    """Small files and whole folders on any store that Spark reads."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _system(self, name: str):
        return self._path(name).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def absolute(self, name: str) -> str:
        """The name with its store, the same for every way to write it."""
        return self._system(name).makeQualified(self._path(name)).toString()

    def exists(self, name: str) -> bool:
        return self._system(name).exists(self._path(name))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._system(folder).listStatus(self._path(folder)))

    def rename(self, old: str, new: str) -> None:
        if not self._system(old).rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not become {new}")

    def delete(self, name: str) -> None:
        self._system(name).delete(self._path(name), True)

    def write(self, name: str, text: str) -> None:
        out = self._system(name).create(self._path(name), True)
        out.write(text.encode())
        out.close()

    def read(self, name: str) -> str:
        stream = self._system(name).open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


@dataclass(frozen=True)
class Entry:
    """A refresh that is not closed: its number, the last mark it made, and what the marks say."""

    number: str
    mark: str
    facts: dict[str, str | None]


class Journal:
    """Open refreshes of one relation, in a folder of their own."""

    def __init__(self, files: Files, folder: str):
        self.files, self.folder = files, folder

    def begin(self, **facts: str | None) -> str:
        number = uuid.uuid4().hex
        self._mark(number, BEGUN, facts)
        return number

    def switching(self, number: str, **facts: str | None) -> None:
        self._mark(number, SWITCHING, facts)

    def close(self, number: str) -> None:
        """The entry's last mark goes first: what is left of it then says less, never more."""
        for mark in (SWITCHING, BEGUN):
            self.files.delete(f"{self.folder}/{number}.{mark}")

    def entries(self) -> list[Entry]:
        found: dict[str, Entry] = {}
        for name in self.files.names(self.folder):
            number, _, mark = name.partition(".")
            facts = self._facts(name)
            if mark not in (BEGUN, SWITCHING) or (facts is None and mark == SWITCHING):
                continue
            before = found.get(number)
            known = (before.facts if before else {}) | (facts or {})
            found[number] = Entry(number, SWITCHING if before and before.mark == SWITCHING else mark, known)
        return list(found.values())

    def _mark(self, number: str, mark: str, facts: dict[str, str | None]) -> None:
        self.files.write(f"{self.folder}/{number}.{mark}", json.dumps(facts))

    def _facts(self, name: str) -> dict[str, str | None] | None:
        try:
            return json.loads(self.files.read(f"{self.folder}/{name}"))
        except ValueError:
            return None
