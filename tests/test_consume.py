import json

import pytest

from eventpulse.schemas import TWEET
from eventpulse.sources.readers import posts_of_tweets, read_posts
from eventpulse.streaming.consume import ARCHIVE, DELETE, KEEP, Intake


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "in"
    (root / "sub dir").mkdir(parents=True)
    for name, rows in {"a.json": 3, "b.json": 4, "sub dir/c d.json": 5, "empty.json": 0}.items():
        (root / name).write_text("".join(
            json.dumps({"extended_tweet": {"full_text": f"{name} {i}"}, "timestamp_ms": str(i)}) + "\n"
            for i in range(rows)
        ))
    return root


def files(root):
    return sorted(str(p.relative_to(root)) for p in root.rglob("*.json")) if root.exists() else []


class Job:
    def __init__(self, spark, folder, tmp_path, **options):
        self.intake = Intake(spark, str(folder), str(tmp_path / "state"), **options)
        self.table, self.fail = str(tmp_path / "table"), None

    def __call__(self, rows, batch):
        posts = posts_of_tweets(rows).select("text", "timestamp_ms")
        posts.write.mode("overwrite").parquet(self.intake.folder_of(self.table, batch))
        if batch == self.fail:
            raise OSError("lost")

    def texts(self):
        return sorted(r.text for r in self.intake.read(self.table, "text string, timestamp_ms string").collect())


@pytest.mark.parametrize("then", [DELETE, ARCHIVE, KEEP])
def test_every_file_is_read_once(spark, folder, tmp_path, then):
    want = sorted(r.text for r in read_posts(spark, str(folder)).collect())
    before, archive = files(folder), tmp_path / "done"
    job = Job(spark, folder, tmp_path, then=then, archive=str(archive) if then == ARCHIVE else None)
    assert job.intake.run(job, files_per_batch=2) == 2
    assert job.texts() == want and len(want) == 12
    assert files(folder) == (before if then == KEEP else [])
    assert files(archive) == (before if then == ARCHIVE else [])
    noted = {r.file.rsplit("/", 1)[1]: (r.batch, r.rows) for r in job.intake.manifest().collect()}
    assert {n: rows for n, (_, rows) in noted.items()} == {"a.json": 3, "b.json": 4, "c%20d.json": 5, "empty.json": 0}
    (folder / "late.json").write_text(json.dumps({"extended_tweet": {"full_text": "late"}}) + "\n")
    assert job.intake.run(job) == 1 and job.texts() == sorted([*want, "late"])
    assert job.intake.run(job) == 0


def test_a_batch_that_fails_midway_is_done_again(spark, folder, tmp_path):
    want, job = sorted(r.text for r in read_posts(spark, str(folder)).collect()), Job(spark, folder, tmp_path)
    job.fail = 1
    with pytest.raises(OSError):
        job.intake.run(job, files_per_batch=1)
    assert len(files(folder)) == 3 and job.intake.batches() == 1  # one batch is complete
    done = job.texts()
    job.fail = None
    again = Job(spark, folder, tmp_path)
    again.intake.run(again)
    assert again.texts() == want and set(done) <= set(want) and files(folder) == []


def test_a_crash_between_the_manifest_and_the_removal(spark, folder, tmp_path, monkeypatch):
    want, job = sorted(r.text for r in read_posts(spark, str(folder)).collect()), Job(spark, folder, tmp_path)
    remove, calls = Intake._remove, []

    def crash(self, noted):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost")
        remove(self, noted)

    monkeypatch.setattr(Intake, "_remove", crash)
    with pytest.raises(OSError):
        job.intake.run(job)
    assert len(files(folder)) == 4 and job.intake.batches() == 1
    monkeypatch.setattr(Intake, "_remove", remove)
    assert job.intake.run(job) == 0 and files(folder) == []
    assert job.texts() == want


def test_no_folder_and_bad_options(spark, tmp_path):
    job = Job(spark, tmp_path / "no", tmp_path)
    assert job.intake.run(job) == 0 and job.texts() == [] and job.intake.manifest().count() == 0
    with pytest.raises(ValueError):
        Intake(spark, "x", "y", then=ARCHIVE)
    assert TWEET is job.intake.schema
