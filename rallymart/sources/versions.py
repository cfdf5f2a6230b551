"""Versions of a landed entity: data folders side by side, and commits that say which ones count.

A write puts its files into a folder of its own and then adds a commit, a small numbered file that
names the folder of every bucket. Readers follow the last commit. So a stop at any moment leaves
either the old state or the new one, and a load only needs to write the buckets it changes.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

#: Commits that stay readable after a newer one, for those who still read what they name.
KEPT = 2


@dataclass(frozen=True)
class Commit:
    """What an entity consists of.

    `folders` maps each bucket, or "" where there are none, to a folder below the entity's base.
    Documents lie in `buckets` buckets by a hash of `keys`. `plain` says that the documents are
    still in the plain file or folder that was landed first. `schema` is that of the documents.
    """

    number: int = 0
    plain: bool = False
    keys: tuple[str, ...] = ()
    buckets: int = 0
    schema: str | None = None
    folders: dict[str, str] = field(default_factory=dict)
    time: int = 0


def base_of(folder: str, entity: str) -> str:
    return f"{folder.rstrip('/')}/.{entity}.versions"


def new_folder() -> str:
    return f"v-{uuid.uuid4().hex}"


class Files:
    """The Hadoop file system that a path lies on."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._jvm = spark._jvm
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, path: str) -> dict[str, int]:
        """Names in a folder with their times of change; none if there is no folder."""
        if not self.exists(path):
            return {}
        found = self._fs.listStatus(self._path(path))
        return {f.getPath().getName(): f.getModificationTime() for f in found}

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def time(self, path: str) -> int:
        return self._fs.getFileStatus(self._path(path)).getModificationTime()

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def move(self, old: str, new: str) -> None:
        if self.exists(new) or not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be moved to {new}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _commits(files: Files, base: str) -> list[int]:
    return sorted(int(n) for n in files.names(f"{base}/commits") if n.isdigit())


def _load(files: Files, base: str, number: int) -> Commit:
    path = f"{base}/commits/{number:012d}"
    fields = json.loads(files.read(path))
    return Commit(**{**fields, "keys": tuple(fields["keys"]), "time": files.time(path)})


def latest(spark: SparkSession, base: str) -> Commit | None:
    files = Files(spark, base)
    numbers = _commits(files, base)
    return _load(files, base, numbers[-1]) if numbers else None


def lost(spark: SparkSession, base: str) -> bool:
    """Whether there are data folders but no commit, which no stop leaves behind."""
    files = Files(spark, base)
    return not _commits(files, base) and any(n.startswith("v-") for n in files.names(base))


def add(spark: SparkSession, base: str, commit: Commit) -> None:
    """Make a commit the last one. It is moved into place whole, and never over another one."""
    files = Files(spark, base)
    fields = asdict(commit)
    del fields["time"]
    beside = f"{base}/commits/.{uuid.uuid4().hex}"
    files.write(beside, json.dumps(fields))
    files.move(beside, f"{base}/commits/{commit.number:012d}")


def discard_old(spark: SparkSession, base: str, kept: int = KEPT) -> None:
    """Delete the commits before the last `kept` ones, and the folders that only those name."""
    files = Files(spark, base)
    numbers = _commits(files, base)
    needed = {f for n in numbers[-kept:] for f in _load(files, base, n).folders.values()}
    versions = {f.split("/")[0] for f in needed}
    for number in numbers[:-kept]:
        for folder in _load(files, base, number).folders.values():
            if folder not in needed:
                files.delete(f"{base}/{folder}")
            if folder.split("/")[0] not in versions:
                files.delete(f"{base}/{folder.split('/')[0]}")
        files.delete(f"{base}/commits/{number:012d}")
