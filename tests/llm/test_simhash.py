import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventpulse.llm import simhash as s
from eventpulse.llm._graph import components


def classes(nodes, linked, pairs=None):
    first = {n: n for n in nodes}

    def find(n):
        while first[n] != n:
            n = first[n]
        return n

    for a, b in itertools.combinations(nodes, 2) if pairs is None else pairs:
        if pairs or linked(a, b):
            x, y = sorted((find(a), find(b)))
            first[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("radius", [1, 2, 3, 4, 6])
def test_every_pair_within_the_radius_meets_in_a_table(radius):
    masks, rng = s.covering_masks(radius), random.Random(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        apart = sum(1 << p for p in rng.sample(range(64), radius))
        assert any(apart & m == 0 for m in masks)


@pytest.mark.parametrize("radius,bucket_rows", [(4, 1024), (4, 2), (3, 1024), (3, 2), (1, 2), (0, 1024), (0, 2)])
def test_classes_equal_brute_force(spark, radius, bucket_rows):
    rng = random.Random(5)
    words = [rng.getrandbits(64) for _ in range(12)]
    for _ in range(150):  # chains of steps of up to six bits
        flips = sum(1 << p for p in rng.sample(range(64), rng.randint(1, 6)))
        words.append(rng.choice(words) ^ flips)
    words = sorted({w - (1 << 64) if w >> 63 else w for w in words})
    want = classes(words, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= radius)
    fps = spark.createDataFrame([(w,) for w in words], "fp bigint")
    got = {r.node: r.root for r in components(s.links(fps, radius, bucket_rows)).collect()}
    assert {w: got.get(w, w) for w in words} == want


def test_components_of_a_long_path_and_of_a_star(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    out = components(spark.createDataFrame(path, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in out} == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}


def brute(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    grams = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    fp = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return f"{fp:016x}"


def test_fingerprints_and_groups_of_texts(spark):
    long = " ".join(f"w{i % 977}" for i in range(70_000))
    texts = ["a b c d e", "A  b\tc\x0bd\ne", "É b", "é b", "a", "", None, "x y z", long, " \n"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "5 AS fp", "6 AS component_id"
    )
    out = {r.doc_id: r for r in s.near_duplicates(rows, shingle=4, radius=4).select(
        "doc_id", "component_id", s.hex16(F.col("fp")).alias("h")).collect()}
    assert [out[i].h for i in range(len(texts))] == [brute(t, 4) for t in texts]
    assert out[1].component_id == 0 and out[6].component_id == out[9].component_id == 5
    assert s.near_duplicates(rows.limit(0), shingle=4, radius=4).count() == 0


def test_null_and_repeated_ids(spark):
    rows = spark.createDataFrame([(None, "a"), (4, "a"), (4, "a"), (None, "q")], "doc_id bigint, text string")
    out = s.near_duplicates(rows, shingle=4, radius=4).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in out) == [
        ("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")
    ]


def test_forest_links_stay_in_a_class():
    fps = np.array([0, 1, 3, 7, 7 << 40, (7 << 40) + 1], np.int64)
    assert {a for a, _ in s._forest(fps, 1)} == {1, 3, 7, (7 << 40) + 1}


def test_forest_links_reach_over_the_sign_bit():
    low = -(1 << 63)
    fps = np.array([0, low, low + 1, low + 3, low + (7 << 30), 7 << 30, -1], np.int64)
    bits = {int(x): int(x) & (2**64 - 1) for x in fps}
    for radius in (1, 2, 3, 4):
        want = classes(sorted(bits), lambda a, b: (bits[a] ^ bits[b]).bit_count() <= radius)
        first = {n: n for n in bits}
        for member, root in s._forest(fps, radius):
            first[member] = root
        assert {n: first[n] for n in bits} == want


def test_classes_of_the_driver_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(2500)
    prints = s.fingerprints(docs, shingle=4).select("fp").distinct().collect()
    words = np.array(sorted(r.fp for r in prints), np.int64)
    apart = np.bitwise_count(words.view(np.uint64)[:, None] ^ words.view(np.uint64)[None, :])
    near = [(int(words[i]), int(words[j])) for i, j in zip(*np.nonzero(apart <= 4))]
    want = classes(words.tolist(), None, near)
    fps = spark.createDataFrame([(int(w),) for w in words], "fp bigint")
    for bucket_rows in (1024, 4):
        got = {r.node: r.root for r in components(s.links(fps, 4, bucket_rows)).collect()}
        assert {w: got.get(w, w) for w in words.tolist()} == want
