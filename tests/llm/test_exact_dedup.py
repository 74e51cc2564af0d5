from collections import defaultdict

import pytest

from eventpulse.llm import exact_dedup
from eventpulse.llm.exact_dedup import build_index, exact_groups, text_key


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("bits", [64, 2, 1])
def test_groups_are_those_of_equal_texts_however_many_keys_collide(spark, bits):
    texts = ["a", "A", "b", "ab", "", None, "É", "é", "b", "B", "x y", "X Y"]
    rows = list(enumerate(texts)) + [(None, "b"), (3, "ab"), (None, None)]
    out = exact_groups(rows_of(spark, rows), key_bits=bits, capacity=1).collect()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(lower)].append(doc_id)
    want = sorted(
        (str(i), str(max((j for j in ids if j is not None), default=None)), len(ids))
        for ids in groups.values() for i in ids
    )
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in out) == want
    assert sum(r.kept for r in out) == len(groups)  # one of each, also where ids repeat
    assert all(r.doc_id == r.keep_id for r in out if r.kept)
    assert len({(r.text_sha256) for r in out}) == len(groups)
    if bits < 64:
        assert max(r.link for r in out) > 1


def test_directory_doubles_until_buckets_fit(spark):
    keys = spark.range(1000).selectExpr("cast(id as string) t").select(text_key("t").alias("key"))
    index = build_index(keys, capacity=40)
    sizes = index.groupBy("bucket", "local_depth").count().collect()
    assert max(r["count"] for r in sizes) <= 40 and index.count() == 1000
    assert len({r.local_depth for r in sizes}) > 1  # only overfull buckets were split
    one = build_index(spark.createDataFrame([(7,)] * 50, "key bigint"), capacity=1, max_depth=3)
    assert [(r.key, r.n) for r in one.collect()] == [(7, 50)]


def test_beyond_the_broadcast_bound_and_empty_and_clashing(spark):
    rows = rows_of(spark, [(1, "a"), (2, "A"), (3, "c")]).selectExpr(
        "doc_id", "text", "1 AS kept", "'x' AS norm", "2 AS `key`", "3 AS `row.no`"
    )
    out = {r.doc_id: (r.keep_id, r.kept) for r in exact_groups(rows, broadcast_keys=0).collect()}
    assert out == {1: (2, False), 2: (2, True), 3: (3, True)}
    assert exact_groups(rows.limit(0)).count() == 0


def test_the_directory_decides(spark, monkeypatch):
    """Rows of keys that no slot leads to would not be chained."""
    table = spark.createDataFrame([(i, f"text {i % 40}") for i in range(120)], "doc_id bigint, text string")
    right = exact_dedup.exact_groups(table, capacity=4).where("group_size = 3").count()
    whole = exact_dedup.directory

    def halved(*args, **options):
        slots, depth = whole(*args, **options)
        return slots.where("slot % 2 = 0"), depth

    monkeypatch.setattr(exact_dedup, "directory", halved)
    wrong = exact_dedup.exact_groups(table, capacity=4).where("group_size = 3").count()
    assert right == 120 and 0 < wrong < 120
