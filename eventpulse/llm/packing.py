"""Packing of tokenised documents into sequences by a grouping genetic algorithm on islands.

Documents become token ids; what is longer than a sequence is cut, and full pieces are sequences
of their own. All shorter pieces are to be packed into as few sequences as possible. They are dealt
to shards of some thousand pieces by a hash, so that every shard sees all lengths, and each shard
is bred on several islands, which are separate rows and may run on separate machines. A solution is
a grouping of pieces into bins. A crossover injects whole well-filled bins of one parent into the
other, removes the bins that hold the same pieces, and puts displaced pieces back by best fit in
order of length. After each epoch the elite of an island migrates to the next one of its shard.

Bins that are all but full are final. The pieces of all other bins go on to a further round with
fewer shards, until one shard is left or a round no longer halves what is left.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventpulse.llm._common import broadcast_if_small, col, numbered, saved, shuffle_parts

CAPACITY = 4096
END = 1  # fixed value: the id after each document

SHARD_PIECES = 4096
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 4
POPULATION = 4
# A bin is final when at most this share of it is free.
FINAL_FREE = 1 / 500
BROADCAST_PLACES = 1_000_000
SEED = 9
CACHED_WORDS = 400_000

# ---- tokens -------------------------------------------------------------------

# The characters up to U+017F that lower-casing maps one to one, and common punctuation. In a text
# of these, normalisation is lower-casing alone.
_KNOWN = [chr(i) for i in (*range(0x130), *range(0x131, 0x180), *range(0x2010, 0x2028))]


def _class(*kinds: str) -> str:
    """The known characters beyond ASCII of some Unicode categories."""
    return "".join(
        re.escape(c) for c in _KNOWN if c > "\x7f" and unicodedata.category(c)[0] in kinds
    )


def word_pattern() -> tuple[re.Pattern, re.Pattern]:
    """What a text must consist of to be split here, and the tokenizer's words in lower case."""
    letters, numbers = "a-z" + _class("L"), "0-9" + _class("N")
    blanks = r"\t\n\v\f\r \x85\xa0" + _class("Z")
    known = re.compile("[" + "".join(re.escape(c) for c in _KNOWN) + "]*")
    words = re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{blanks}{letters}{numbers}]+"
    )
    return known, words


def byte_alphabet() -> dict[int, str]:
    """The characters by which byte-level tokenizers spell bytes: fixed values, given by their rule.

    Visible Latin-1 characters spell themselves; the other bytes take those from U+0100 on, in order.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds(dict):
    """Ids of words as bytes, from the tokenizer's model where they are not remembered."""

    def __init__(self, tokenizer, size: int):
        super().__init__()
        self.model, self.size, self.alphabet = tokenizer.model, size, byte_alphabet()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.size:
            self.clear()
        ids = self[word] = self._ids(word)
        return ids

    def _ids(self, word: str) -> bytes:
        if not word.isascii() or not word.isprintable():
            word = "".join(map(self.alphabet.__getitem__, word.encode()))
        ids = [t.id for t in self.model.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)


def id_bytes(texts: list[str | None], tokenizer, words: WordIds, patterns) -> list[bytes]:
    """Ids of each text, and :data:`END`, as little-endian 32-bit numbers.

    Texts of common characters are split into the tokenizer's words here, and each distinct word
    is encoded once; the tokenizer takes any other text, and one that may hold a special token, whole.
    """
    known, pattern = patterns
    end, out = np.array([END], "<u4").tobytes(), []
    for text in texts:
        text = text or ""
        if "<|" in text or not (text.isascii() or known.fullmatch(text)):
            ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        else:
            ids = b"".join(map(words.__getitem__, pattern.findall(text.lower())))
        out.append(ids + end)
    return out


def token_pieces(
    table: DataFrame, tokenizer_file: str, *, capacity: int = CAPACITY,
    id_column: str = "doc_id", text: str = "text", keep_ids: bool = True,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` per piece, and its ``ids`` if asked for.

    ``ids`` are little-endian unsigned 32-bit numbers in one binary value.
    """
    rows = table.select(col(id_column).alias("doc_id"), col(text).cast("string").alias("text"))

    def cut(batches):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(tokenizer_file)
        words, patterns = WordIds(tokenizer, CACHED_WORDS), word_pattern()
        step = 4 * capacity
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                where, out = [], []
                for i, ids in enumerate(id_bytes(part.column(1).to_pylist(), tokenizer, words, patterns)):
                    for piece, start in enumerate(range(0, len(ids), step)):
                        own = ids[start:start + step]
                        where.append(i)
                        out.append((piece, start // 4, len(own) // 4, zlib.crc32(own), own))
                columns = [part.column(0).take(pa.array(where, pa.int32()))]
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                columns += [pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                wanted = len(names) if keep_ids else len(names) - 1
                yield pa.RecordBatch.from_arrays(columns[:wanted], names[:wanted])

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return rows.mapInArrow(cut, schema + (", ids binary" if keep_ids else ""))


# ---- one island ---------------------------------------------------------------

def best_fit(order: np.ndarray, lengths: np.ndarray, bins: np.ndarray, loads: list, capacity: int):
    """Put pieces, in this order, into the fullest bin that takes them; opens bins at need."""
    rooms = sorted((capacity - load, b) for b, load in enumerate(loads) if load)
    for piece in order.tolist():
        size = int(lengths[piece])
        at = bisect_left(rooms, (size, -1))
        if at == len(rooms):
            room, b = capacity, len(loads)
            loads.append(0)
        else:
            room, b = rooms.pop(at)
        bins[piece] = b
        loads[b] = capacity - room + size
        insort(rooms, (room - size, b))


def packed(lengths: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    bins = np.full(len(lengths), -1)
    best_fit(order, lengths, bins, [], capacity)
    return bins


def _numbered_bins(bins: np.ndarray) -> np.ndarray:
    """Bins numbered from 0 without gaps; -1 stays."""
    out = np.full(len(bins), -1)
    out[bins >= 0] = np.unique(bins[bins >= 0], return_inverse=True)[1]
    return out


def _refill(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Best fit, longest first, of the pieces that have no bin."""
    bins = _numbered_bins(bins)
    free = np.flatnonzero(bins < 0)
    loads = np.bincount(bins[bins >= 0], lengths[bins >= 0]).astype(int).tolist()
    best_fit(free[np.argsort(-lengths[free], kind="stable")], lengths, bins, loads, capacity)
    return bins


def crossover(
    mother: np.ndarray, father: np.ndarray, lengths: np.ndarray, capacity: int, rng
) -> np.ndarray:
    """The mother's grouping with well-filled bins of the father in it."""
    fill = np.bincount(father, lengths)
    well = fill >= np.median(fill)
    inject = well & (rng.random(len(fill)) < 0.5)
    moved = inject[father]
    broken = np.unique(mother[moved])
    child = np.where(np.isin(mother, broken), -1, mother)
    child[moved] = father[moved] + mother.max() + 1
    return _refill(child, lengths, capacity)


def mutate(bins: np.ndarray, lengths: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Empty the least filled bins and a few at random, and refill."""
    fill = np.bincount(bins, lengths)
    few = max(1, len(fill) // 20)
    gone = np.concatenate([np.argsort(fill)[:few], rng.integers(0, len(fill), few)])
    return _refill(np.where(np.isin(bins, gone), -1, bins), lengths, capacity)


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Larger is better: fewer bins, then fuller ones beside emptier ones."""
    fill = np.bincount(bins, lengths)
    return -len(fill), float(np.square(fill / capacity).sum())


def evolve(
    lengths: np.ndarray, settlers: list[np.ndarray], capacity: int, seed: list[int],
    generations: int = GENERATIONS, population: int = POPULATION,
) -> np.ndarray:
    """The best grouping of an island after some generations, from those who came by sea."""
    rng = np.random.default_rng(seed)
    rate = lambda bins: fitness(bins, lengths, capacity)
    if not settlers:
        settlers = [packed(lengths, np.argsort(-lengths, kind="stable"), capacity)]
    fewest = -(-int(lengths.sum()) // capacity)
    people = list(settlers)
    if -rate(max(people, key=rate))[0] <= fewest:
        return max(people, key=rate)
    while len(people) < population:
        people.append(mutate(people[rng.integers(len(settlers))], lengths, capacity, rng))
    for _ in range(generations):
        if -rate(max(people, key=rate))[0] <= fewest:
            break
        children = []
        for _ in range(population):
            mother, father = (
                max((people[i] for i in rng.integers(len(people), size=2)), key=rate)
                for _ in range(2)
            )
            child = crossover(mother, father, lengths, capacity, rng)
            children.append(mutate(child, lengths, capacity, rng) if rng.random() < 0.5 else child)
        people = sorted(people + children, key=rate, reverse=True)[:population]
    return max(people, key=rate)


# ---- all islands --------------------------------------------------------------

STATE = (
    "shard bigint, island int, pieces array<bigint>, lengths array<bigint>, bins array<int>, "
    "fewer int, fuller double"
)


def _epoch(islands: DataFrame, capacity: int, seed: int) -> DataFrame:
    """Breed every island, whose row may bring groupings: its own and that of a migrant."""

    def breed(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                settlers = [np.array(b) for b in row["settlers"] or []]
                best = evolve(lengths, settlers, capacity, [seed, row["shard"], row["island"]])
                fewer, fuller = fitness(best, lengths, capacity)
                out = row | {"bins": best.tolist(), "fewer": fewer, "fuller": fuller}
                del out["settlers"]
                yield pa.RecordBatch.from_pylist([out], pa.schema([
                    ("shard", pa.int64()), ("island", pa.int32()), ("pieces", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int64())), ("bins", pa.list_(pa.int32())),
                    ("fewer", pa.int32()), ("fuller", pa.float64()),
                ]))

    return islands.select("shard", "island", "pieces", "lengths", "settlers").mapInArrow(breed, STATE)


def _spread(islands: DataFrame, count: int) -> DataFrame:
    """A row is much work: one task for each, as far as there are partitions."""
    parts = max(1, min(count, 4 * shuffle_parts(islands.sparkSession)))
    return islands.repartition(parts, "shard", "island")


def _bred(pieces: DataFrame, shards: int, capacity: int, turn: int) -> DataFrame:
    """The best grouping of each shard, ``(shard, pieces, lengths, bins)``."""
    shard = F.pmod(F.xxhash64("piece_no", F.lit(turn)), F.lit(shards).cast("bigint"))
    listed = pieces.groupBy(shard.alias("shard")).agg(
        F.sort_array(F.collect_list(F.struct("piece_no", "length"))).alias("p")
    ).select("shard", F.col("p.piece_no").alias("pieces"), F.col("p.length").alias("lengths"))
    islands = listed.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    islands = islands.withColumn("settlers", F.lit(None).cast("array<array<int>>"))
    for epoch in range(EPOCHS):
        spread = _spread(islands, shards * ISLANDS)
        bred = saved(_epoch(spread, capacity, SEED + 1000 * turn + epoch), "islands")
        migrants = bred.select(
            "shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("bins").alias("migrant")
        )
        islands = bred.join(migrants, ["shard", "island"]).withColumn(
            "settlers", F.array("bins", "migrant")
        )
    best = F.max_by(F.struct("pieces", "lengths", "bins"), F.struct("fewer", "fuller", "island"))
    return bred.groupBy("shard").agg(best.alias("b")).select("shard", "b.*")


def _placed(groupings: DataFrame, turn: int, capacity: int) -> DataFrame:
    """``piece_no, length, sequence_id, offset, free`` for every piece of the groupings."""

    def lay_out(batches):
        for batch in batches:
            for row in batch.to_pylist():
                bins, lengths = np.array(row["bins"], np.int64), np.array(row["lengths"], np.int64)
                order = np.argsort(bins, kind="stable")
                before = np.cumsum(lengths[order]) - lengths[order]
                first = np.concatenate([[True], np.diff(bins[order]) > 0])
                offsets = before - np.maximum.accumulate(np.where(first, before, 0))
                free = capacity - np.bincount(bins, lengths)[bins[order]].astype(np.int64)
                sequence = (turn << 56) + (row["shard"] << 24) + bins[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(row["pieces"], np.int64)[order]), pa.array(lengths[order]),
                     pa.array(sequence), pa.array(offsets), pa.array(free)],
                    ["piece_no", "length", "sequence_id", "offset", "free"],
                )

    return groupings.mapInArrow(
        lay_out, "piece_no bigint, length bigint, sequence_id bigint, offset bigint, free bigint"
    )


def pack_pieces(
    pieces: DataFrame, *, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """``(piece_no, sequence_id, offset)`` for pieces ``(piece_no, length)`` shorter than the
    capacity, in as few sequences as found. Numbers of pieces are distinct."""
    left, turn, done = saved(pieces.select("piece_no", "length"), "left"), 0, None
    count = left.count()
    while True:
        shards = max(1, -(-count // shard_pieces))
        placed = saved(_placed(_bred(left, shards, capacity, turn), turn, capacity), "placed")
        open_bins = placed.where(F.col("free") > int(capacity * FINAL_FREE))
        still = open_bins.count() if shards > 1 else 0
        last = shards == 1 or 2 * still > count or not still
        final = placed if last else placed.where(F.col("free") <= int(capacity * FINAL_FREE))
        final = final.select("piece_no", "sequence_id", "offset")
        done = final if done is None else done.unionByName(final)
        if last:
            return done
        left, count, turn = open_bins.select("piece_no", "length"), still, turn + 1


def pack_documents(
    table: DataFrame, tokenizer_file: str, *, capacity: int = CAPACITY,
    id_column: str = "doc_id", text: str = "text", keep_ids: bool = True,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece of a document: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``, and the piece's ``ids`` unless they are not asked for.

    Only documents longer than the capacity are cut. Within a sequence, pieces lie one after the
    other from offset 0. A null or empty text is its end token alone. Ids of documents may be null
    or repeated: rows are packed one by one. An empty table gives no rows; other columns are not
    looked at.
    """
    pieces = token_pieces(
        table, tokenizer_file, capacity=capacity, id_column=id_column, text=text, keep_ids=keep_ids
    )
    pieces = saved(numbered(pieces, "piece_no"), "pieces")
    full = F.col("length") == capacity
    alone = pieces.where(full).withColumns({
        "sequence_id": -F.col("piece_no") - 1, "offset": F.lit(0).cast("bigint")
    })
    short = pieces.where(~full)
    places = pack_pieces(short, capacity=capacity, shard_pieces=shard_pieces)
    # Numbers only: broadcast up to a bound, so that pieces with their ids are not shuffled.
    places = broadcast_if_small(places, BROADCAST_PLACES)
    together = short.join(places, "piece_no").select(alone.columns)
    return alone.unionByName(together).drop("piece_no")
