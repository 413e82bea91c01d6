"""Folders and small files beside the tables, through the file system that Spark itself uses."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from tidemark.contract import HOUR_COLUMNS
from tidemark.functions.partition_hours import hour_of_folders

#: Renames that are under way at the same time.
THREADS = 16


class Folders:
    """The folders below one root."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self._path = jvm.org.apache.hadoop.fs.Path
        self._system = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str = "") -> list[str]:
        """What lies right below a folder, in order; nothing if there is no such folder."""
        if not self.exists(name):
            return []
        return sorted(status.getPath().getName() for status in self._system.listStatus(self._at(name)))

    def exists(self, name: str) -> bool:
        return self._system.exists(self._at(name))

    def delete(self, name: str) -> None:
        self._system.delete(self._at(name), True)

    def move_here(self, source: Folders, name: str) -> None:
        """Put a folder of ``source`` in the place of the folder of that name, which need not exist."""
        self.delete(name)
        self._system.mkdirs(self._at(name).getParent())
        if not self._system.rename(source._at(name), self._at(name)):
            raise OSError(f"cannot move {source.root}/{name} to {self.root}/{name}")

    def read_json(self, name: str) -> dict | None:
        if not self.exists(name):
            return None
        stream = self._system.open(self._at(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write_json(self, name: str, value: dict) -> None:
        """Replace a small file: it is written under another name and then renamed, never left half written."""
        folder, _, last = name.rpartition("/")
        draft = f"{folder}/.{last}-{uuid.uuid4().hex}" if folder else f".{last}-{uuid.uuid4().hex}"
        stream = self._system.create(self._at(draft), True)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()
        self._system.delete(self._at(name), False)
        if not self._system.rename(self._at(draft), self._at(name)):
            raise OSError(f"cannot write {self.root}/{name}")

    def hours(self, start_key: int | None = None, end_key: int | None = None, whole: bool = False) -> list[str]:
        """Folders that hold the hours within bounds.

        Each is one hour or, unless ``whole``, a day, month or year all of whose hours are inside.
        Only folders that may hold such hours are listed.
        """
        found: list[str] = []

        def walk(folder: str, values: tuple[int, ...]) -> None:
            first, last = hour_of_folders(values)
            if (end_key is not None and first > end_key) or (start_key is not None and last < start_key):
                return
            inside = (start_key is None or first >= start_key) and (end_key is None or last <= end_key)
            if len(values) == len(HOUR_COLUMNS) or (values and inside and not whole):
                found.append(folder)
                return
            column = HOUR_COLUMNS[len(values)]
            for name in self.names(folder):
                key, _, value = name.partition("=")
                if key == column and value.isdigit():
                    walk(f"{folder}/{name}" if folder else name, (*values, int(value)))

        walk("", ())
        return found


def in_parallel(task, items: list) -> None:
    """Run file system calls at the same time; the first error is raised."""
    with ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(task, items))
