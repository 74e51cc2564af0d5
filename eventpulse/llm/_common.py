"""What the operators share: scratch tables in the shared folder, ASCII lower case, free names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventpulse._session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Folders that this driver has written, oldest first.
_WRITTEN: list[str] = []


def saved(table: DataFrame, purpose: str) -> DataFrame:
    """The table written once into the shared folder and read again.

    It cuts the lineage: a lost executor costs a read of these files, and numbers
    given with :func:`numbered` stay what they were.
    """
    path = shared_folder(table.sparkSession, purpose)
    table.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def leave_scratch() -> None:
    """What has been written so far is not deleted by :func:`discard_scratch`."""
    _WRITTEN.clear()


def discard_scratch(still_read: DataFrame) -> None:
    """Delete what :func:`saved` has written, but for what ``still_read`` reads.

    For a pipeline that has stored the result of a stage: nothing else that is to be read later
    may come from those folders.
    """
    spark = still_read.sparkSession
    needed = still_read.inputFiles()
    kept = [path for path in _WRITTEN if any(path in file for file in needed)]
    for path in _WRITTEN:
        if path not in kept:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _WRITTEN[:] = kept


def numbered(table: DataFrame, number: str) -> DataFrame:
    """Add a distinct number per row; save the result before it is used twice."""
    return table.withColumn(number, F.monotonically_increasing_id())


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null counts as empty.

    ``lower`` does just that to a text of ASCII characters, and much faster.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def free_name(table: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of the table is called that."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_if_small(table: DataFrame, max_rows: int) -> DataFrame:
    """A saved table of narrow rows, marked for broadcast when it has at most ``max_rows``."""
    return F.broadcast(table) if table.limit(max_rows + 1).count() <= max_rows else table
