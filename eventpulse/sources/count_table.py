"""A table of counts that grows batch by batch.

The table is kept in buckets of its key, each sorted, so that a batch's counts are brought to the
table and the table itself is never shuffled nor sorted. Each merge writes a new version beside the
old one and switches to it together with the number of the batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventpulse.sources.versions import Versions

BUCKETS = 64


# The stored key: text behind a mark, or nothing for null, as null equals nothing in a join.
STORED = "_key"


class CountTable:
    """Counts ``(key, n)`` of texts below the folder ``root``, in ``buckets`` buckets of the key.

    The number of buckets is that of the first merge; a null key is a key like others.
    """

    def __init__(self, spark: SparkSession, root: str, *, key: str = "tag", buckets: int = BUCKETS):
        self.spark, self.key = spark, key
        self.versions = Versions(spark, root)
        current = self.versions.current()
        self.buckets = current.notes["buckets"] if current else buckets

    def read(self) -> DataFrame:
        """The merged counts of all batches so far."""
        current = self.versions.current()
        if current is None:
            return self.spark.createDataFrame([], f"`{self.key}` string, n bigint")
        text = F.when(F.col(STORED) != "", F.expr(f"substring({STORED}, 2)"))
        return self.spark.read.parquet(current.folders[0]).select(text.alias(self.key), "n")

    def merge(self, counts: DataFrame, batch: int) -> None:
        """Add the counts of a batch; one that has been merged before is left out."""
        current = self.versions.current()
        if current and current.notes["batch"] >= batch:
            return
        folder, name = self.versions.stage(), f"counts_{uuid.uuid4().hex}"
        self.merged(counts).write.format("parquet").bucketBy(self.buckets, STORED).sortBy(STORED).option(
            "path", folder
        ).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # of the catalogue; its files stay
        self.versions.commit(folder, batch=batch, buckets=self.buckets)

    def merged(self, counts: DataFrame) -> DataFrame:
        """The stored sums of the table and of further counts, in the table's buckets."""
        key = F.coalesce(F.concat(F.lit("="), F.col(f"`{self.key}`")), F.lit(""))
        new = counts.groupBy(key.alias(STORED)).agg(F.sum("n").alias("n"))
        new = new.repartition(self.buckets, STORED)
        current = self.versions.current()
        if current is None:
            return new
        both = self._bucketed(current.folders[0]).alias("old").join(new.alias("new"), STORED, "full")
        total = F.coalesce("old.n", F.lit(0)) + F.coalesce("new.n", F.lit(0))
        return both.select(STORED, total.alias("n"))

    def _bucketed(self, folder: str) -> DataFrame:
        # Only the catalogue tells Spark of buckets; the name lasts as long as the session.
        name = f"counts_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({STORED} string, n bigint) USING parquet "
            f"CLUSTERED BY ({STORED}) SORTED BY ({STORED}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{folder}'"
        )
        return self.spark.table(name)


def merge_batches(spark: SparkSession, root: str, batches: list[DataFrame], **options) -> DataFrame:
    """Merge the counts of batches one after the other; those merged in an earlier run are skipped."""
    table = CountTable(spark, root, **options)
    for number, counts in enumerate(batches):
        table.merge(counts, number)
    return table.read()
