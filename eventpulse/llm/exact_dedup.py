"""Exact duplicates through an extendible-hash index on shared files. DataFrame functions only.

The index has one entry per key, a 64-bit hash of the normalised text: how many rows carry it.
Its directory maps the leading bits of a key to a bucket. It begins with one bucket, and
doubles while a bucket holds more entries than its capacity: an overfull bucket is split in two
by the next bit, the others are merely named by two slots. A bucket is a range of keys, so the
owner of a bucket reads and writes one range of the index.

Equal keys do not prove equal texts. The index says which keys occur more than once and which bucket
they belong to; their rows go to the owner of the bucket and form a chain there: texts are compared
byte by byte, and a collision gives the chain a second link. Copies are combined before each shuffle,
so a text that makes up a third of all rows is a row per task there, and a few at its owner; the join
that leads rows back to their link may be split by adaptive execution, as both its sides are shuffled
for it.

Texts that occur once are never shuffled: the text is read twice, the second time to pick the
rows of the chains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventpulse.llm._common import broadcast_if_small, col, lower_ascii, numbered, saved

# Entries of a bucket before it is split, and bits that the directory may use: at most 65,536
# slots, which are broadcast. Buckets of the last depth may hold any number of entries.
BUCKET_ENTRIES = 65_536
MAX_DEPTH = 16

# Repeated keys are broadcast up to this number (16 bytes each), and shuffled beyond it.
BROADCAST_KEYS = 1_000_000

# Copies of a text reach the owner of its bucket as so many rows at most.
COMBINED_PARTS = 16

KEY_BITS = 64


def text_key(text: Column, bits: int = KEY_BITS) -> Column:
    """Hash of a normalised text; fewer bits leave the trailing ones zero, which tests use."""
    key = F.xxhash64(text)
    return key if bits == KEY_BITS else F.shiftleft(F.shiftright(key, 64 - bits), 64 - bits)


def slot_of(key: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a key."""
    if depth == 0:
        return F.lit(0).cast("bigint")
    return F.shiftrightunsigned(key, 64 - depth)


def directory(
    keys: DataFrame, *, capacity: int = BUCKET_ENTRIES, max_depth: int = MAX_DEPTH
) -> tuple[DataFrame, int]:
    """The directory ``(slot, bucket, local_depth)`` for distinct keys, and its global depth.

    Counts per leading ``max_depth`` bits are gathered once; each doubling works on them.
    """
    fine = saved(
        keys.groupBy(slot_of(F.col("key"), max_depth).alias("cell")).agg(F.count("*").alias("n")),
        "histogram",
    )
    buckets = fine.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("prefix"), F.lit(0).alias("local_depth")
    )
    depth = 0
    while depth < max_depth:
        at = F.shiftrightunsigned("cell", max_depth - depth).alias("prefix")
        full = (
            fine.groupBy(at).agg(F.sum("n").alias("n")).where(F.col("n") > capacity)
            .select("prefix", F.lit(depth).alias("local_depth"))
        )
        overfull = saved(buckets.join(full, ["prefix", "local_depth"], "left_semi"), "overfull")
        if overfull.isEmpty():
            break
        halves = overfull.select(
            F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"),
            (F.col("local_depth") + 1).alias("local_depth"),
        )
        rest = buckets.join(F.broadcast(overfull), ["prefix", "local_depth"], "left_anti")
        buckets, depth = saved(rest.unionByName(halves), "directory"), depth + 1
    shift = F.lit(depth) - F.col("local_depth")
    first = F.call_function("shiftleft", F.col("prefix"), shift)
    last = first + F.call_function("shiftleft", F.lit(1).cast("bigint"), shift) - 1
    slots = buckets.select(
        F.explode(F.sequence(first, last)).alias("slot"), first.alias("bucket"), "local_depth"
    )
    return slots, depth


def build_index(
    rows: DataFrame, *, capacity: int = BUCKET_ENTRIES, max_depth: int = MAX_DEPTH
) -> DataFrame:
    """The index ``(bucket, local_depth, key, n)`` of a table with a column ``key``, on shared files.

    Entries of a bucket lie together and in order: each owner task writes a range of keys.
    """
    keys = saved(rows.groupBy("key").agg(F.count("*").alias("n")), "keys")
    slots, depth = directory(keys, capacity=capacity, max_depth=max_depth)
    entries = (
        keys.withColumn("slot", slot_of(F.col("key"), depth))
        .join(F.broadcast(slots), "slot")
        .select("bucket", "local_depth", "key", "n")
    )
    owned = entries.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key")
    return saved(owned, "index")


def exact_groups(
    table: DataFrame,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    capacity: int = BUCKET_ENTRIES,
    max_depth: int = MAX_DEPTH,
    key_bits: int = KEY_BITS,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """One row per row of ``table``: its id (as ``doc_id``), ``keep_id``, ``group_size``,
    ``kept``, ``text_sha256``, and ``link``, the place of its text in the chain of its key.

    Texts are equal when they agree byte by byte after A-Z are lower-cased; a null text counts as
    empty. The row of the largest id stays; a null id is smaller than any other. Of rows that
    agree in id and text, exactly one is kept. An empty table gives no rows. Other columns of
    the table are not looked at.
    """
    norm = table.select(col(id_column).alias("doc_id"), lower_ascii(col(text)).alias("norm"))
    keyed = norm.withColumn("key", text_key(F.col("norm"), key_bits))
    index = build_index(keyed.select("key"), capacity=capacity, max_depth=max_depth)

    chained = index.where("n > 1").select(F.col("key").alias("_chained"), "bucket")
    chained = broadcast_if_small(chained, broadcast_keys)
    rows = keyed.join(chained, F.col("key") == F.col("_chained"), "left")
    rows = saved(
        numbered(rows, "row_no").select(
            "doc_id", "row_no", "key", "bucket",
            F.sha2("norm", 256).alias("text_sha256"),
            F.col("bucket").isNotNull().alias("chained"),
            F.when(F.col("bucket").isNotNull(), F.col("norm")).alias("norm"),
        ),
        "rows",
    )
    single = rows.where("NOT chained").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", F.lit(1).alias("link"),
    )
    chains = rows.where("chained")
    links = saved(_owned_chains(chains), "chains")
    copies = chains.join(links, ["key", "norm"]).select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
        (F.col("row_no") == F.col("top.row_no")).alias("kept"), "text_sha256", "link",
    )
    return single.unionByName(copies)


def _owned_chains(chains: DataFrame, parts: int = COMBINED_PARTS) -> DataFrame:
    """``key, norm, top, group_size, link``: the chain of every key, a link per different text.

    Copies are combined on the way, in ``parts`` parts, and go to the owner of their bucket, a task
    that holds a range of keys in order. It compares the texts of a key and numbers them, the one of
    the largest row first.
    """
    part = F.pmod("row_no", F.lit(parts))
    some = chains.groupBy("bucket", "key", "norm", part.alias("part")).agg(
        F.max(F.struct("doc_id", "row_no")).alias("top"), F.count("*").alias("n")
    ).drop("part")
    held = some.repartitionByRange("bucket", "key")
    text = Window.partitionBy("bucket", "key", "norm")
    texts = held.select(
        "bucket", "key", "norm", F.max("top").over(text).alias("top"),
        F.sum("n").over(text).alias("group_size"),
        F.row_number().over(text.orderBy(F.desc("top"))).alias("nth"),
    ).where("nth = 1")
    order = Window.partitionBy("bucket", "key").orderBy(F.desc("top"))
    return texts.select("key", "norm", "top", "group_size", F.row_number().over(order).alias("link"))
