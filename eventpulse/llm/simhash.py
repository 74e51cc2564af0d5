"""SimHash near-duplicates with covering locality-sensitive hashing: no pair is missed.

A fingerprint's bits are put into the tables of a covering family: every bit position has a
vector of ``radius + 1`` bits, every non-zero vector gives a table, and the table looks at the
positions whose vectors are not orthogonal to its own. Any ``radius`` positions are orthogonal to
some non-zero vector, so two fingerprints that differ in at most that many bits agree in all
positions of some table, with certainty.

Links are found between distinct fingerprints, never between documents. A bucket of two is decided
while counting; larger ones are searched within a task that gives a tree of links, not all pairs.
Buckets beyond ``bucket_rows`` take another exact way: two fingerprints are within the radius
exactly when some word lies within half of it from both, rounded down for one and up for the other,
so each member names all words that near, and members that share a word are one component. No word
is named by more members than lie that near to it, whatever the bucket's size.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from eventpulse.llm._common import col, saved
from eventpulse.llm._graph import components

BITS = 64
SEED = 42  # fixed value: the seed of the shingle hash
BUCKET_ROWS = 1024


def simhash(text: str | None, shingle: int) -> int:
    """The fingerprint of a text, as a signed 64-bit number; zero for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = slice(at, at + (1 << 16))
        hashes = np.array(
            [digest(joined[s:e], SEED) for s, e in zip(starts[part], ends[part])], "<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    majority = np.packbits(counts * 2 > n, bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprints(
    table: DataFrame, *, shingle: int, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, fp)`` per row; a null text counts as empty and has fingerprint zero."""
    rows = table.select(col(id_column).alias("doc_id"), col(text).cast("string").alias("text"))

    def hashed(batches):
        for batch in batches:
            fps = [simhash(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"]
            )

    return rows.mapInArrow(hashed, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp bigint")


def covering_masks(radius: int, seed: int = 0) -> list[int]:
    """Masks such that any two words within ``radius`` bits agree under one of them.

    Positions share the non-zero vectors evenly, so each mask keeps about half of the bits.
    """
    size = (1 << radius + 1) - 1
    positions = list(range(BITS))
    random.Random(seed).shuffle(positions)
    vectors = {p: 1 + i % size for i, p in enumerate(positions)}
    return [
        sum(1 << p for p in range(BITS) if (vectors[p] & v).bit_count() % 2)
        for v in range(1, size + 1)
    ]


def _signed(word: int) -> int:
    return word - (1 << BITS) if word >= 1 << BITS - 1 else word


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _longs(words: list[int]) -> Column:
    return F.expr("array(" + ", ".join(f"{_signed(w)}L" if _signed(w) != -(1 << 63)
                                       else "(-9223372036854775807L - 1L)" for w in words) + ")")


def _forest(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links (member, first) that connect what chains of links within the radius connect."""
    left = np.sort(fps)
    while len(left):
        first, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            # Of signed numbers, the bits of the absolute value would be counted.
            near = np.bitwise_count((left ^ front[0]).view(np.uint64)) <= radius
            for member in left[near]:
                yield int(member), int(first)
            front, left = np.concatenate([front[1:], left[near]]), left[~near]


def _bucket_links(members: DataFrame, radius: int) -> DataFrame:
    """Links within buckets ``(t, key)``, whose members come one after the other."""

    def links(batches):
        held_key, held = None, np.empty(0, np.int64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None and not batch.num_rows:
                continue
            if batch is None:
                keys, fps = np.empty((0, 2), np.int64), np.empty(0, np.int64)
            else:
                keys = np.stack([batch.column(i).to_numpy() for i in (0, 1)], 1).astype(np.int64)
                fps = batch.column(2).to_numpy()
            if held_key is not None:
                keys = np.concatenate([np.repeat([held_key], len(held), 0), keys])
                fps = np.concatenate([held, fps])
            if not len(fps):
                continue
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            groups = np.split(fps, cuts)
            if batch is not None:  # the last bucket may go on
                held_key, held = keys[-1], groups.pop()
            found = [link for g in groups for link in _forest(g, radius)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    placed = members.repartition("t", "key").sortWithinPartitions("t", "key")
    return placed.select("t", "key", "fp").mapInArrow(links, "a bigint, b bigint")


def _dense_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links among any number of fingerprints through the words between them.

    Each names the words within half the radius, rounded up, and marks those within half of it,
    rounded down. Two fingerprints within the radius share a word that one of them has marked, and
    whoever shares a marked word is within the radius of the one that marked it. So all that share
    a word are linked to the smallest that has marked it.
    """
    flips = [
        (sum(1 << p for p in places), k <= radius // 2)
        for k in range((radius + 1) // 2 + 1) for places in itertools.combinations(range(BITS), k)
    ]
    far = next((i for i, (_, marked) in enumerate(flips) if not marked), len(flips))
    named = fps.select("fp", F.posexplode(_longs([f for f, _ in flips])).alias("i", "flip"))
    words = named.select(
        "fp", F.col("flip").bitwiseXOR(F.col("fp")).alias("word"), (F.col("i") < far).alias("marked")
    )
    least = saved(
        words.groupBy("word").agg(
            F.min(F.when(F.col("marked"), F.col("fp"))).alias("b"),
            F.min("fp").alias("lo"), F.max("fp").alias("hi"),
        ).where("b IS NOT NULL AND lo <> hi").select("word", "b"),
        "between",
    )
    return words.join(least, "word").where("fp <> b").select(F.col("fp").alias("a"), "b")


def links(fps: DataFrame, radius: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct fingerprints ``fp`` as all pairs within the
    radius do. Each joins two of one component."""
    tables = fps.select("fp", F.posexplode(_longs(covering_masks(radius))).alias("t", "mask"))
    placed = tables.select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    counted = placed.groupBy("t", "key").agg(
        F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
    )
    shared = saved(counted.where("n > 1"), "buckets")
    found = shared.where("n = 2").where(_apart("a", "b") <= radius).select("a", "b")
    some = shared.where((F.col("n") > 2) & (F.col("n") <= bucket_rows)).select("t", "key")
    found = found.unionByName(_bucket_links(placed.join(some, ["t", "key"], "left_semi"), radius))
    many = shared.where(F.col("n") > bucket_rows).select("t", "key")
    if not many.isEmpty():
        dense = saved(placed.join(many, ["t", "key"], "left_semi").select("fp").distinct(), "dense")
        found = found.unionByName(_dense_links(dense, radius))
    return found


def near_duplicates(
    table: DataFrame,
    *,
    shingle: int,
    radius: int,
    id_column: str = "doc_id",
    text: str = "text",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row: the smallest id reachable over links of
    fingerprints that differ in at most ``radius`` bits, the row's own included.

    A null or empty text has fingerprint zero and is linked like any other; a text of fewer words
    than a shingle is one shingle. Ids may be repeated; a null id never becomes a component's id
    unless all of the component are null. An empty table gives no rows; other columns are not
    looked at.
    """
    rows = saved(fingerprints(table, shingle=shingle, id_column=id_column, text=text), "prints")
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), radius, bucket_rows))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = saved(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = saved(rooted.join(smallest, "root").select("fp", "component_id"), "components")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def hex16(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
