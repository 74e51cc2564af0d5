"""The incremental form: new files in, counts and flagged posts out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from eventpulse._session import shared_folder
from eventpulse._skew import digest
from eventpulse.calendars import TOURNAMENT, Calendar
from eventpulse.functions.time import event_millis
from eventpulse.operators.as_of import assign_as_of
from eventpulse.operators.terms import LIKE, compile_terms, flag_posts
from eventpulse.operators.windows import HALF_OPEN, WindowTable, count_per_window
from eventpulse.schemas import TWEET
from eventpulse.sources.versions import Versions


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType = TWEET,
    *,
    format: str = "json",
    files_per_batch: int | None = None,
    consume: str = "off",
    archive: str | None = None,
) -> DataFrame:
    """A stream of the files of a folder, each read once.

    ``consume`` says what happens to a file that has been read: ``off`` leaves
    it, ``delete`` removes it, ``archive`` moves it to the folder ``archive``. A
    file goes once a later batch has committed, so the files of the last batch
    stay where they are.
    """
    reader = spark.readStream.schema(schema).format(format).option("cleanSource", consume)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if consume == "archive":
        reader = reader.option("sourceArchiveDir", archive)
    return reader.load(path)


def running_counts(
    posts: DataFrame, calendar: Calendar = TOURNAMENT, *, time: str = "timestamp_ms",
    bounds: str = HALF_OPEN,
) -> DataFrame:
    """Count per window over all files so far; the state has one row per bucket.

    A calendar that is a table of any size cannot stream row by row: see :func:`run_counts_by_table`.
    """
    if not isinstance(calendar, Calendar):
        raise ValueError("a window table goes batch by batch; use run_counts_by_table")
    return count_per_window(posts, calendar, time=time, bounds=bounds)


def flag_stream(
    posts: DataFrame,
    terms: DataFrame,
    *,
    mode: str = LIKE,
    time: str = "timestamp_ms",
    copies_within: str | None = None,
) -> DataFrame:
    """Flagged posts of a stream, row by row and without state.

    With ``copies_within``, such as ``"1 hour"``, exact copies arriving within that
    span of event time are dropped. The span is also the watermark: a post later
    than that is dropped by the state; one without a usable time goes past it, copies
    and all. A list that does not fit into a plan has to be joined, batch by batch:
    :func:`run_flagged` takes a list of any size.
    """
    compiled = compile_terms(terms, mode=mode)
    if compiled is None:
        raise ValueError("the filter list is too large for a plan; use run_flagged")
    flagged = posts.where(compiled.found_in("text"))
    if copies_within is None:
        return flagged
    timed = flagged.withColumn("event_time", F.timestamp_millis(event_millis(time)))
    distinct = (
        timed.where("event_time is not null")
        .withWatermark("event_time", copies_within)
        .dropDuplicatesWithinWatermark(["text", time])
    )
    return distinct.unionByName(timed.where("event_time is null")).drop("event_time")


def flag_batches(
    posts: DataFrame,
    terms: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    mode: str = LIKE,
) -> StreamingQuery:
    """Flag micro-batch by micro-batch with a list of any size, handing each to ``write``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        write(flag_posts(batch, terms, mode=mode), batch_id)

    return (
        posts.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_flagged(
    posts: DataFrame, terms: DataFrame, path: str | None = None, *, mode: str = LIKE,
    progress: str | None = None,
) -> DataFrame:
    """Flag a stream over all files present into a table, and read that table.

    The list may have any size. Beyond a plan, each batch replaces its own folder,
    so one that is repeated after a failure is not doubled. With ``path`` and ``progress`` of
    an earlier run it goes on from there.
    """
    spark = posts.sparkSession
    if compile_terms(terms, mode=mode) is not None:
        return run_to_parquet(flag_stream(posts, terms, mode=mode), path, progress)
    path = path or shared_folder(spark, "rows")
    empty = spark.createDataFrame([], posts.schema)
    empty.write.mode("overwrite").parquet(f"{path}/batch=-1")

    def write(flagged: DataFrame, batch_id: int) -> None:
        flagged.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    progress = progress or shared_folder(spark, "progress")
    flag_batches(posts, terms, write, progress, mode=mode).awaitTermination()
    return spark.read.parquet(path).select(*posts.columns)


def without_copies(rows: DataFrame, text: str = "text", time: str = "timestamp_ms") -> DataFrame:
    """``text`` and ``time`` of a stream, exact copies once however far apart they arrive.

    A state for each distinct pair is kept for good, by the SHA-256 of the text. It is partitioned
    by these keys; :func:`state_on_disk` keeps it out of the executors' memory.
    """
    keyed = rows.select(text, time).withColumn("_digest", digest(text))
    return keyed.dropDuplicates(["_digest", time]).drop("_digest")


DISK_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in a store on disk, saved with their progress."""
    settings = {
        "spark.sql.streaming.stateStore.providerClass": DISK_STATE,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_flagged_distinct(
    posts: DataFrame, terms: DataFrame, path: str | None = None, *, mode: str = LIKE,
    time: str = "timestamp_ms", progress: str | None = None,
) -> DataFrame:
    """Flagged ``(text, time)`` of all files present, copies dropped over the whole stream.

    The same as :func:`eventpulse.operators.terms.drop_copies` of all flagged posts, for a list of
    any size: beyond a plan the flagged posts are first written as a table, which is streamed in turn,
    so that a batch of it which is repeated after a failure meets its own state. With ``path`` and
    ``progress`` of an earlier run it goes on from there.
    """
    spark = posts.sparkSession
    progress = progress or shared_folder(spark, "progress")
    if compile_terms(terms, mode=mode) is not None:
        flagged = flag_stream(posts, terms, mode=mode)
    else:
        between = f"{progress}/flagged-rows"
        run_flagged(posts, terms, between, mode=mode, progress=f"{progress}/flagged")
        flagged = spark.readStream.schema(posts.schema).parquet(between)
    with state_on_disk(spark):
        return run_to_parquet(without_copies(flagged, time=time), path, f"{progress}/distinct")


def run_counts_by_table(
    posts: DataFrame, calendar: WindowTable, root: str | None = None, *, time: str = "timestamp_ms",
    bounds: str = HALF_OPEN, progress: str | None = None,
) -> DataFrame:
    """Count per window of a calendar that is a table, over all files so far.

    Batch by batch, the distinct times are merged with the windows, and the counts added to those of
    earlier batches. The sums and the number of the batch change together, so that a batch which is
    repeated after a failure is not counted twice. With ``root`` and ``progress`` of an earlier run
    it goes on from there.
    """
    def counts(batch: DataFrame) -> DataFrame:
        times = batch.groupBy(time).agg(F.count(F.lit(1)).alias("n"))
        return assign_as_of(
            times, calendar.windows, base_ms=calendar.base_ms, before=calendar.before,
            other=calendar.other, time=time, bounds=bounds,
        ).select("bucket", "n")

    return run_sums(posts, counts, "bucket int, n bigint", root, progress=progress)


def run_sums(
    rows: DataFrame, delta: Callable[[DataFrame], DataFrame], schema: str, root: str | None = None,
    *, progress: str | None = None,
) -> DataFrame:
    """Sums that are kept up to date batch by batch over all files so far.

    ``delta`` gives what a batch adds, a table of ``schema``: a key and numbers. It is added to the
    sums of earlier batches, and the new sums replace them together with the number of the batch, so
    that a batch which is repeated after a failure is not added twice.
    """
    spark = rows.sparkSession
    versions = Versions(spark, root or shared_folder(spark, "sums"))
    key, *numbers = StructType.fromDDL(schema).names

    def each(batch: DataFrame, batch_id: int) -> None:
        current = versions.current()
        if current and current.notes["batch"] >= batch_id:
            return
        found = delta(batch).select(key, *numbers)
        if current:
            found = found.unionByName(spark.read.schema(schema).parquet(*current.folders))
        folder = versions.stage()
        found.groupBy(key).agg(*[F.sum(n).alias(n) for n in numbers]).write.parquet(folder)
        versions.commit(folder, batch=batch_id)

    query = (
        rows.writeStream.foreachBatch(each)
        .option("checkpointLocation", progress or shared_folder(spark, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    current = versions.current()
    if current is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*current.folders)


def run_counts(counts: DataFrame) -> DataFrame:
    """Run a counting stream over all files present and give the final counts.

    Each batch replaces the table of counts in the shared folder.
    """
    spark = counts.sparkSession
    path = shared_folder(spark, "counts")
    spark.createDataFrame([], counts.schema).write.parquet(path)

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    query = (
        counts.writeStream.foreachBatch(write).outputMode("complete")
        .option("checkpointLocation", shared_folder(spark, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(counts.schema).parquet(path)


def run_to_parquet(
    rows: DataFrame, path: str | None = None, progress: str | None = None
) -> DataFrame:
    """Run a row stream over all files present into a table, and read that table.

    With the folder ``progress`` of an earlier run it goes on from there.
    """
    spark = rows.sparkSession
    path = path or shared_folder(spark, "rows")
    query = (
        rows.writeStream.format("parquet").outputMode("append")
        .option("path", path)
        .option("checkpointLocation", progress or shared_folder(spark, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)
