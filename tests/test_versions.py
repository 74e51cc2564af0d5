import pytest
from pyspark.sql import functions as F

from eventpulse.operators.tags import merge_counts
from eventpulse.sources.count_table import CountTable, merge_batches
from eventpulse.sources.readers import read_tag_counts
from eventpulse.sources.versions import Versions, publish, published, read_published
from eventpulse.sources.writers import write_report, write_tag_counts


@pytest.fixture
def counts_of(spark):
    def make(**counts):
        return spark.createDataFrame(list(counts.items()), "tag string, n bigint")
    return make


def pairs(table):
    return {r.tag: r.n for r in table.collect()}


def failing(spark):
    """A table whose job fails midway."""
    bad = F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.lit("x"))
    return spark.range(0, 1000, 1, 8).select(bad.cast("string").alias("tag"), F.col("id").alias("n"))


def test_a_job_that_fails_midway_leaves_the_old_output(spark, counts_of, tmp_path):
    root = str(tmp_path / "tags")
    publish(spark, root, lambda path: write_tag_counts(counts_of(a=1, b=2), path))
    with pytest.raises(Exception, match="lost"):
        publish(spark, root, lambda path: write_tag_counts(failing(spark), path))
    assert pairs(read_tag_counts(spark, published(spark, root))) == {"a": 1, "b": 2}
    publish(spark, root, lambda path: write_tag_counts(counts_of(c=3), path))
    assert pairs(read_tag_counts(spark, published(spark, root))) == {"c": 3}


def test_a_reader_keeps_the_version_it_began_with(spark, counts_of, tmp_path):
    root = str(tmp_path / "counts")
    publish(spark, root, counts_of(a=1).write.parquet, day=1)
    old = read_published(spark, root)
    version = publish(spark, root, counts_of(a=2).write.parquet, day=2)
    assert pairs(old) == {"a": 1} and pairs(read_published(spark, root)) == {"a": 2}
    assert version.number == 2 and Versions(spark, root).current().notes == {"day": 2}


def test_sweep_keeps_the_last_versions_and_drops_what_was_never_committed(spark, counts_of, tmp_path):
    versions = Versions(spark, str(tmp_path / "counts"))
    for day in range(4):
        folder = versions.stage()
        counts_of(a=day).write.parquet(folder)
        versions.commit(folder, day=day)
    counts_of(a=9).write.parquet(versions.stage())
    versions.sweep(keep=1)
    assert len([p for p in (tmp_path / "counts").iterdir() if p.name.startswith("data-")]) == 1
    assert pairs(spark.read.parquet(*versions.current().folders)) == {"a": 3}
    assert versions.current().number == 4


def test_nothing_published(spark, tmp_path):
    assert Versions(spark, str(tmp_path / "no")).current() is None
    with pytest.raises(FileNotFoundError):
        published(spark, str(tmp_path / "no"))


def test_batches_are_merged_once_each(spark, counts_of, tmp_path):
    root, batches = str(tmp_path / "t"), [counts_of(a=1, b=2), counts_of(b=5, c=7), counts_of()]
    assert pairs(merge_batches(spark, root, batches, buckets=4)) == {"a": 1, "b": 7, "c": 7}
    again = merge_batches(spark, root, [*batches, counts_of(a=10)], buckets=99)
    assert pairs(again) == {"a": 11, "b": 7, "c": 7}
    assert pairs(merge_counts(*batches, counts_of(a=10))) == pairs(again)


def test_a_null_tag_and_a_failed_merge(spark, counts_of, tmp_path):
    table = CountTable(spark, str(tmp_path / "t"), buckets=2)
    assert pairs(table.read()) == {}
    table.merge(spark.createDataFrame([(None, 1), ("x", 2)], "tag string, n bigint"), 0)
    with pytest.raises(Exception, match="lost"):
        table.merge(failing(spark), 1)
    assert pairs(table.read()) == {None: 1, "x": 2}
    table.merge(spark.createDataFrame([(None, 4)], "tag string, n bigint"), 1)
    assert pairs(CountTable(spark, str(tmp_path / "t")).read()) == {None: 5, "x": 2}


def test_the_table_is_not_shuffled_by_a_merge(spark, counts_of, tmp_path):
    table = CountTable(spark, str(tmp_path / "t"), buckets=16)
    table.merge(counts_of(a=1, b=2), 0)
    plan = table.merged(counts_of(b=1))._jdf.queryExecution().executedPlan().toString()
    scan = next(i for i, line in enumerate(plan.splitlines()) if "FileScan parquet" in line)
    above = plan.splitlines()[:scan]
    joins = [i for i, line in enumerate(above) if "SortMergeJoin" in line]
    assert joins and not any("Exchange" in line for line in above[joins[-1]:]), plan
    assert "Bucketed: true" in plan
