"""Results that are replaced as a whole: written beside the old ones, then switched by a manifest.

Overwriting a folder deletes it first, and a driver that is lost then leaves nothing. Here each version
of a result has folders of its own, and a small file names those of the version that holds. It is
written last, under a name that no version had before, so a reader sees the old version or the new
one, and a job that fails leaves the old one in place. One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Version:
    """A version of a result: its number, its folders, and what else was noted with it."""

    number: int
    folders: tuple[str, ...]
    notes: dict = field(default_factory=dict)


class Versions:
    """The versions of one result below a folder that every executor can reach."""

    MANIFESTS = "_versions"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def current(self) -> Version | None:
        """The version that holds, None before the first one."""
        numbers = self._numbers()
        return self._read(max(numbers)) if numbers else None

    def stage(self, name: str = "data") -> str:
        """A fresh folder name; what is written there holds once it is committed."""
        return f"{self.root}/{name}-{uuid.uuid4().hex}"

    def commit(self, *folders: str, **notes) -> Version:
        """Make these folders the current version."""
        number = max(self._numbers(), default=0) + 1
        body = json.dumps({"folders": folders, "notes": notes})
        target, hidden = self._path(self._name(number)), self._path(f"{self.MANIFESTS}/.{uuid.uuid4().hex}")
        out = self._fs().create(hidden)
        out.write(bytearray(body, "utf-8"))
        out.close()
        if self._fs().exists(target) or not self._fs().rename(hidden, target):
            raise RuntimeError(f"another writer has committed version {number} of {self.root}")
        return Version(number, folders, notes)

    def sweep(self, keep: int = 2) -> None:
        """Delete the folders and manifests of all versions but the last ``keep``, and what was
        staged and never committed. Not while something is being written."""
        numbers = sorted(self._numbers())
        held = {f.rstrip("/").rsplit("/", 1)[-1] for n in numbers[-keep:] for f in self._read(n).folders}
        for status in self._list(self.root):
            name = status.getPath().getName()
            if name != self.MANIFESTS and name not in held:
                self._fs().delete(status.getPath(), True)
        for n in numbers[:-keep]:
            self._fs().delete(self._path(self._name(n)), False)

    def _name(self, number: int) -> str:
        return f"{self.MANIFESTS}/{number:012d}.json"

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, folder: str) -> list:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return list(self._fs().listStatus(path)) if self._fs().exists(path) else []

    def _numbers(self) -> list[int]:
        names = [s.getPath().getName() for s in self._list(f"{self.root}/{self.MANIFESTS}")]
        return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]

    def _read(self, number: int) -> Version:
        stream = self._fs().open(self._path(self._name(number)))
        try:
            body = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(body)
        return Version(number, tuple(found["folders"]), found["notes"])


def publish(spark: SparkSession, root: str, write: Callable[[str], None], **notes) -> Version:
    """Let ``write`` write into a fresh folder, and switch to it once it is complete.

    ``write`` is any of the writers, as ``lambda path: write_tag_counts(counts, path)``.
    """
    versions = Versions(spark, root)
    folder = versions.stage()
    write(folder)
    return versions.commit(folder, **notes)


def published(spark: SparkSession, root: str) -> str:
    """The folder of the version that holds; to be read with the reader of its format."""
    current = Versions(spark, root).current()
    if current is None:
        raise FileNotFoundError(f"nothing has been published in {root}")
    return current.folders[0]


def read_published(spark: SparkSession, root: str, format: str = "parquet", **options) -> DataFrame:
    return spark.read.options(**options).format(format).load(published(spark, root))
