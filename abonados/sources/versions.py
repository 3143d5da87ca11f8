"""Versions of a layer: which load of each table belongs together.

A version is one small file, ``_versions/<number>.json`` below the layer's folder, that
names the load of every table. It is created exclusively, so of two writers that commit
the same number one goes on to the next, upon what the other left. The highest version
that can be read is the current one; all its tables become current in that moment.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_versions"


class Versions:
    """The versions of the layer whose tables are below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _files(self):
        return self._path().getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, below: str = "") -> dict[str, int]:
        """Names in a folder, with the time in ms when each was changed last."""
        path = self._path(below)
        files = self._files()
        if not files.exists(path):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(path)}

    def numbers(self) -> list[int]:
        """All version numbers, in order; a version that was not written whole included."""
        return sorted(int(name[:-5]) for name in self._names(FOLDER) if name.endswith(".json"))

    def loads(self, number: int) -> dict[str, str] | None:
        """The load of each table in a version; None if it was not written whole."""
        stream = self._files().open(self._path(f"{FOLDER}/{number:010d}.json"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        try:
            return json.loads(text)
        except json.JSONDecodeError:
            return None

    def current(self) -> dict[str, str]:
        """The loads of the newest whole version; none before the first."""
        for number in reversed(self.numbers()):
            loads = self.loads(number)
            if loads is not None:
                return loads
        return {}

    def commit(self, changed: dict[str, str]) -> int:
        """Makes the loads current, beside those of other tables. Returns the number."""
        while True:
            number = max(self.numbers(), default=0) + 1
            text = json.dumps({**self.current(), **changed}, indent=1)
            try:
                out = self._files().create(self._path(f"{FOLDER}/{number:010d}.json"), False)
            except Py4JJavaError as error:
                if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                    raise
                continue  # another writer was first
            out.write(bytearray(text.encode()))
            out.close()
            return number

    def garbage(
        self, keep: int, older_than: float, folder_of: Callable[[str], str] = str
    ) -> tuple[list[str], list[int]]:
        """Versions before the ``keep`` newest whole ones, and folders of loads (``folder_of``
        tells a load's) that no other version names. What changed in the last ``older_than`` seconds stays: it may still
        be written, or read by a query that began before."""
        before = (time.time() - older_than) * 1000
        changed = self._names(FOLDER)
        whole = {n: loads for n in self.numbers() if (loads := self.loads(n)) is not None}
        gone = [n for n in list(whole)[:-keep] if changed[f"{n:010d}.json"] <= before]
        held = {folder_of(load) for n, loads in whole.items() if n not in gone for load in loads.values()}
        loads = [name for name, at in self._names().items() if "__" in name and name not in held and at <= before]
        return loads, gone

    def remove(self, loads: list[str], numbers: list[int]) -> None:
        """Deletes versions, then folders of loads."""
        files = self._files()
        for name in [*(f"{FOLDER}/{n:010d}.json" for n in numbers), *loads]:
            files.delete(self._path(name), True)
