"""Publishing without a gap.

Data is written to a folder of its own first; what readers see is switched by
adding one small numbered file to ``<folder>/_published``. A reader takes the
newest entry that is whole, so it sees either the state before a write or the
state after it, whatever happens to the writer. Entries are never rewritten,
which needs no atomic replace from the file system.

One writer at a time per folder; any number of readers.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LOG = "_published"
#: Entries, and the data they name, that stay for readers still at work on them.
KEEP = 3


class Files:
    """The few operations needed of the Hadoop file system of a folder (local, HDFS, object stores alike)."""

    def __init__(self, spark: SparkSession, folder: str):
        try:
            self._jvm = spark.sparkContext._jvm
            self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        except Exception as exc:
            raise RuntimeError(f"cannot look for {folder}: this session has no access to the Hadoop file systems") from exc
        self._fs = self.path(folder).getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return bool(self._fs.exists(self.path(name)))

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        if not self.exists(folder):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self.path(folder))]

    def modified(self, name: str) -> float:
        return self._fs.getFileStatus(self.path(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str = "") -> bool:
        """Write a new small file; False if there is one of that name."""
        try:
            stream = self._fs.create(self.path(name), False)
        except Py4JJavaError:
            if self.exists(name):
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


class Log:
    """The numbered entries of a published folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self.files = Files(spark, folder)

    def _numbers(self) -> list[int]:
        """Newest first."""
        names = self.files.names(f"{self.folder}/{LOG}")
        return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)

    def _name(self, number: int) -> str:
        return f"{self.folder}/{LOG}/{number:012d}.json"

    def _entry(self, number: int) -> dict | None:
        """None where the entry is being written, or was removed meanwhile."""
        try:
            return json.loads(self.files.read(self._name(number)))
        except (Py4JJavaError, ValueError):
            return None

    def current(self) -> dict | None:
        """The newest whole entry; None if nothing was published yet."""
        while True:
            numbers = self._numbers()
            for number in numbers:
                if (entry := self._entry(number)) is not None:
                    return entry
            # all gone or half written: look again, unless nothing changed
            if numbers == self._numbers():
                return None

    def entries(self) -> list[dict]:
        """Whole entries, newest first."""
        return [e for n in self._numbers() if (e := self._entry(n)) is not None]

    def publish(self, entry: dict) -> int:
        number = max(self._numbers(), default=0) + 1
        while not self.files.create(self._name(number), json.dumps(entry, sort_keys=True)):
            number += 1
        return number

    def forget(self, keep: int = KEEP) -> list[dict]:
        """Remove all entries but the ``keep`` newest whole ones and return those removed."""
        whole, gone = 0, []
        for number in self._numbers():
            entry = self._entry(number)
            if entry is not None and whole < max(1, keep):
                whole += 1
            elif whole:  # older than what is kept
                self.files.delete(self._name(number))
                gone += [entry] if entry is not None else []
        return gone


def current_folder(spark: SparkSession, path: str) -> str:
    """Where the rows of a table are: the published version of a folder with a log, else the folder itself."""
    entry = Log(spark, path).current()
    return f"{path.rstrip('/')}/{entry['data']}" if entry and "data" in entry else path
