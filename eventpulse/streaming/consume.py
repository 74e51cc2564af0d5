"""Intake that consumes its files: each is read once, noted in a manifest, and only then removed.

A crash may come at any point. Before the manifest names a batch, its files are still in place and
the batch is done again under the same number, replacing what it wrote. Afterwards its files are never
read again; a next run first removes those that are left. So no row is lost and none counts twice.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from eventpulse.schemas import TWEET
from eventpulse.sources.versions import Versions

KEEP, DELETE, ARCHIVE = "keep", "delete", "archive"


def _one_form(file: Column) -> Column:
    """Local paths are written with one slash or three."""
    return F.regexp_replace(file, "^file:/+", "file:/")


class Intake:
    """The files that arrive in ``folder``, and below ``state`` the manifest of those that were read.

    ``then`` says what becomes of a file once the manifest names it: it stays, is deleted, or moves to
    the folder ``archive`` under its path below ``folder``. Files that stay are told by the manifest.
    """

    def __init__(
        self, spark: SparkSession, folder: str, state: str, *, schema: StructType = TWEET,
        format: str = "json", then: str = DELETE, archive: str | None = None,
    ):
        if then not in (KEEP, DELETE, ARCHIVE) or (then == ARCHIVE) != (archive is not None):
            raise ValueError("then must be 'keep', 'delete', or 'archive' with a folder for it")
        self.spark, self.folder, self.then, self.archive = spark, folder.rstrip("/"), then, archive
        self.schema, self.format = schema, format
        self.versions = Versions(spark, state)

    def manifest(self) -> DataFrame:
        """``file, batch, rows`` of everything that was read."""
        schema = "file string, batch bigint, rows bigint"
        current = self.versions.current()
        if current is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*current.folders)

    def batches(self) -> int:
        """How many batches were completed; the next one has this number."""
        current = self.versions.current()
        return 0 if current is None else current.notes["batches"]

    def run(
        self, process: Callable[[DataFrame, int], None], files_per_batch: int | None = None
    ) -> int:
        """Hand all files present to ``process(rows, batch)``, and return the number of batches.

        What ``process`` writes must depend on the batch's number alone, as a folder that it
        overwrites does; :meth:`folder_of` and :meth:`read` are such a table.
        """
        self._remove(self.manifest())
        waiting, done = self._waiting(), 0
        step = files_per_batch or max(len(waiting), 1)
        for at in range(0, len(waiting), step):
            number, files = self.batches(), waiting[at:at + step]
            rows = self._read(files)
            process(rows, number)
            self._note(rows, files, number)
            self._remove(self.manifest().where(F.col("batch") == number))
            done += 1
        return done

    def folder_of(self, table: str, batch: int) -> str:
        return f"{table}/batch={batch}"

    def read(self, table: str, schema: StructType | str) -> DataFrame:
        """Of a table with a folder per batch, the batches that were completed."""
        folders = [self.folder_of(table, n) for n in range(self.batches())]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def _read(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).format(self.format).load([unquote(f) for f in files])

    def _waiting(self) -> list[str]:
        """The files that the manifest does not name, by path."""
        if not self._exists(self.folder):
            return []
        present = self.spark.read.schema(self.schema).option("recursiveFileLookup", True).format(
            self.format
        ).load(self.folder).inputFiles()
        if self.then != KEEP:
            return sorted(present)
        known = self.spark.createDataFrame([(f,) for f in present], "file string").join(
            self.manifest(), "file", "left_anti"
        )
        return sorted(r.file for r in known.collect())

    def _note(self, rows: DataFrame, files: list[str], number: int) -> None:
        """Name the batch and its files in the manifest."""
        read = rows.groupBy(_one_form(F.col("_metadata.file_path")).alias("_name")).agg(
            F.count("*").alias("rows")
        )
        listed = self.spark.createDataFrame([(f, number) for f in files], "file string, batch bigint")
        noted = listed.join(read, _one_form(F.col("file")) == F.col("_name"), "left").select(
            "file", "batch", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")
        )
        folder, current = self.versions.stage("files"), self.versions.current()
        noted.coalesce(1).write.parquet(folder)
        self.versions.commit(*(current.folders if current else ()), folder, batches=number + 1)

    def _remove(self, noted: DataFrame) -> None:
        """Remove files that the manifest names, as far as they are still there."""
        if self.then == KEEP or not self._exists(self.folder):
            return
        root = self._path(self.folder)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        top = fs.makeQualified(root).toUri().getPath()
        current = self.versions.current()
        last = current.notes["batches"] - 1 if current else -1
        for row in noted.where(F.col("batch") == last).select("file").collect():
            path = self._path(unquote(row.file))
            if not fs.exists(path):
                continue
            if self.then == DELETE:
                fs.delete(path, False)
            else:
                below = path.toUri().getPath().removeprefix(top).lstrip("/")
                target = self._path(f"{self.archive.rstrip('/')}/{below}")
                fs.mkdirs(target.getParent())
                fs.rename(path, target)

    def _exists(self, folder: str) -> bool:
        path = self._path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)
