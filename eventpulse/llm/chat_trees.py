"""Chat formatting as prefix trees: turns that conversations share at their beginning come once.

The conversations form a forest: a node is a turn together with all turns before it. Nodes are laid
out depth-first in one line of characters. A node's characters have the positions they have in each
conversation through it, and see the characters of its ancestors, of no other branch: each block of
nodes names the places of its ancestors, and each node the place up to which later ones see it.

Nothing is gathered per conversation or per tree, as one of them may hold a third of all turns:

* Turns are range-partitioned by conversation and order. A scan of each partition gives every turn a
  hash of all turns up to it, its number and its position; a conversation that goes on in the next
  partition is carried over by composing the scans of whole partitions, a few numbers each.
* Nodes are the groups of equal hashes. Only where a node has several children does a new block
  begin, so what is kept in lists are the blocks on the way to a block. A conversation from which
  others branch off at B places stands beside B others that hold at least 1, 2, .. B turns, so a list
  is at most as long as the square root of twice the number of all turns.
* Sorted by these lists, the blocks are in depth-first order; sums of their sizes give their places.

The hash of a beginning is a polynomial of the SHA-256 digests of its turns, modulo two primes of 61
and 60 bits; nodes whose members differ in turn or parent raise an error.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from eventpulse.llm._common import broadcast_if_small, col, numbered, saved, shuffle_parts

# The template: marks around a turn, by role; any other role is named between ROLE marks.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"),
}
OTHER, ROLE, END = "<role>", "</role>", "</turn>"
CONTROLS = tuple(chain(*MARKS.values(), (OTHER, ROLE, END)))
CODES = "0123456789"
LEARNT = "assistant"

# Forks are broadcast up to this many (16 bytes each), and shuffled beyond.
BROADCAST_ROWS = 500_000

PRIMES = ((1 << 61) - 1, (1 << 60) - 93)
BASES = (0x1A5C3D7E9B2F4861, 0x0C7B5E3F1D29A865)


# ---- template -----------------------------------------------------------------

def escaped(text: Column) -> Column:
    r"""No control string is left: a backslash becomes ``\\``, the i-th control string ``\i``."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for code, control in zip(CODES, CONTROLS):
        out = F.replace(out, F.lit(control), F.lit("\\" + code))
    return out


def unescaped(text: str) -> str:
    return re.sub(
        r"\\(.)", lambda m: m[1] if m[1] == "\\" else CONTROLS[CODES.index(m[1])], text, flags=re.S
    )


def formatted(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """A turn's characters, and where its text begins and ends in them."""
    role, body = F.coalesce(role, F.lit("")), escaped(text)
    opening, closing = F.concat(F.lit(OTHER), escaped(role), F.lit(ROLE)), F.lit(END)
    for name, (before, after) in MARKS.items():
        opening = F.when(role == name, F.lit(before)).otherwise(opening)
        closing = F.when(role == name, F.lit(after)).otherwise(closing)
    begin = F.length(opening) + 1
    piece = F.concat(opening, F.lit(" "), body, F.lit(" "), closing)
    return piece, begin.cast("bigint"), (begin + F.length(body)).cast("bigint")


_TURN = re.compile(
    "(?:" + "|".join(re.escape(before) for before, _ in MARKS.values())
    + f"|{re.escape(OTHER)}(.*?){re.escape(ROLE)}) (.*) (?:"
    + "|".join(re.escape(x) for x in (*[after for _, after in MARKS.values()], END)) + ")", re.S,
)
_ROLE_OF = {before: role for role, (before, _) in MARKS.items()}


def read_turn(piece: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, text = _TURN.fullmatch(piece).groups()
    if role is None:
        return _ROLE_OF[piece[:piece.index(" ")]], unescaped(text)
    return unescaped(role), unescaped(text)


# ---- the way to every turn ------------------------------------------------------

State = tuple[int, int, int, int]  # turns, both hashes, characters
START: State = (0, 0, 0, 0)


def _then(state: State, more: State) -> State:
    """The state behind two stretches of turns."""
    n, *hashes = (more[0], more[1], more[2])
    moved = [
        (h * pow(base, n, p) + x) % p for h, x, base, p in zip(state[1:3], hashes, BASES, PRIMES)
    ]
    return state[0] + n, moved[0], moved[1], state[3] + more[3]


_STATE = ("k", "h1", "h2", "stop")
_BEFORE = ("g1", "g2", "pos")


def _scanned(turns: DataFrame) -> DataFrame:
    """Add, within each partition, the states before and after each turn of its conversation."""
    kept = turns.select("row_no", "conv", "x1", "x2", "chars")
    schema = ", ".join(
        [f"row_no bigint, conv {kept.schema['conv'].dataType.simpleString()}, part int, seq bigint",
         "head boolean, x1 bigint", *[f"{c} bigint" for c in (*_STATE, *_BEFORE)]]
    )

    def scan(batches):
        part, seq, head, current, state = TaskContext.get().partitionId(), 0, True, None, START
        for batch in batches:
            if not batch.num_rows:
                continue
            convs = batch.column(1).to_pylist()
            out = [[] for _ in range(9)]
            for conv, x1, x2, chars in zip(convs, *[batch.column(i).to_pylist() for i in (2, 3, 4)]):
                if seq and conv != current:
                    head, state = False, START
                before, current = state, conv
                state = (
                    state[0] + 1, (state[1] * BASES[0] + x1 + 1) % PRIMES[0],
                    (state[2] * BASES[1] + x2 + 1) % PRIMES[1], state[3] + chars,
                )
                for column, value in zip(out, (seq, head, *state, *before[1:])):
                    column.append(value)
                seq += 1
            arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.bool_()), batch.column(2)]
            arrays += [pa.array(c, pa.int64()) for c in out[2:]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([part] * batch.num_rows, pa.int32()), *arrays],
                ["row_no", "conv", "part", "seq", "head", "x1", *_STATE, *_BEFORE],
            )

    return kept.mapInArrow(scan, schema)


def _carried(scanned: DataFrame) -> DataFrame:
    """The states from the beginning of the conversation, where it began in another partition.

    A few numbers per partition pass through the driver.
    """
    ends = scanned.groupBy("part").agg(
        F.min_by("conv", "seq").alias("first"),
        F.max_by(F.struct("conv", "head", *_STATE), "seq").alias("last"),
    ).orderBy("part").collect()
    carried: dict[int, State] = {}
    conv, state = None, START
    for i, row in enumerate(ends):
        into = state if i and conv == row["first"] else START
        if into != START:
            carried[row["part"]] = into
        last = tuple(row["last"][c] for c in _STATE)
        conv, state = row["last"]["conv"], _then(into, last) if row["last"]["head"] else last

    def moved(batches):
        for batch in batches:
            table = batch.to_pydict()
            for i, (part, head) in enumerate(zip(table["part"], table["head"])):
                if head and part in carried:
                    into = carried[part]
                    before = _then(into, (table["k"][i] - 1, *[table[c][i] for c in _BEFORE]))
                    after = _then(into, tuple(table[c][i] for c in _STATE))
                    for name, value in zip((*_STATE, *_BEFORE), (*after, *before[1:])):
                        table[name][i] = value
            yield pa.RecordBatch.from_pydict(table, schema=batch.schema)

    return scanned.mapInArrow(moved, scanned.schema) if carried else scanned


# ---- places ---------------------------------------------------------------------

def _placed(sizes: DataFrame, key: str, size: str) -> DataFrame:
    """Add ``start``: the sum of the sizes of all rows with a smaller key. A number per partition
    passes through the driver."""
    ordered = saved(numbered(sizes.orderBy(key), "place"), "ordered")
    ordered = ordered.withColumn("part", F.shiftright("place", 33))  # numbers begin with the partition
    totals = ordered.groupBy("part").agg(F.sum(size).alias("n")).orderBy("part").collect()
    offsets, at = [], 0
    for row in totals:
        offsets.append((row["part"], at))
        at += row["n"]
    spark = sizes.sparkSession
    begins = F.broadcast(spark.createDataFrame(offsets, "part bigint, begin bigint"))
    before = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return ordered.withColumn("inside", F.coalesce(F.sum(size).over(before), F.lit(0))).join(
        begins, "part"
    ).withColumn("start", F.col("begin") + F.col("inside")).drop("part", "place", "begin", "inside")


@dataclass(frozen=True)
class Forest:
    """The output, as three tables.

    ``nodes``: ``block, start, length, position, visible_to, piece, loss_start, loss_end``. The turn's
    characters ``piece`` take the places from ``start`` on; the first has position id ``position``.
    Later characters see them up to the place ``visible_to``. ``loss_start`` to ``loss_end`` is the
    stretch of ``piece`` that is learnt, null where nothing is.

    ``blocks``: ``block, length, tree, attends``. A block is a row of nodes without branches; ``block``
    and ``tree`` are the places at which it and its tree begin, ``attends`` the places of its ancestors
    and its own, ``(start, stop)`` from the root on.

    ``ends``: ``conv_id, n_turns, block, stop``. A conversation ends in that block, before that place.

    All places together are gapless from 0.
    """

    nodes: DataFrame
    blocks: DataFrame
    ends: DataFrame


def prefix_forest(
    table: DataFrame,
    *,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> Forest:
    """The conversations laid out as prefix trees; a row of the table is a turn.

    Turns of a conversation come in order of ``turn``, null first; equal ones in order of their hash.
    A null role or text counts as empty. Rows with a null conversation are one conversation.
    Repeated rows are turns of their own. Texts and conversations may be of any length; other
    columns are not looked at; an empty table gives empty tables.
    """
    piece, begin, end = formatted(col(role).cast("string"), col(text).cast("string"))
    # As a struct, null equals null.
    conv = F.struct(col(conversation).alias("id"))
    shaped = table.select(
        conv.alias("conv"), col(turn).alias("turn"), piece.alias("piece"), begin.alias("begin"),
        end.alias("end"), (F.coalesce(col(role).cast("string"), F.lit("")) == LEARNT).alias("learnt"),
    ).withColumn("digest", F.sha2("piece", 256))
    turns = saved(numbered(shaped.select(
        "conv", "turn", "piece", F.length("piece").cast("bigint").alias("chars"),
        F.when(F.col("learnt"), F.col("begin")).alias("loss_start"),
        F.when(F.col("learnt"), F.col("end")).alias("loss_end"),
        *[F.conv(F.substring("digest", at, 15), 16, 10).cast("bigint").alias(name)
          for at, name in ((1, "x1"), (16, "x2"))],
    ), "row_no"), "turns")

    order = [F.col(c) for c in ("conv", "turn", "x1", "x2", "row_no")]
    narrow = turns.select(*order, "chars")
    dealt = narrow.repartitionByRange(shuffle_parts(table.sparkSession), *order)
    ways = saved(_carried(saved(_scanned(dealt.sortWithinPartitions(*order)), "scan")), "ways")

    nodes = saved(
        ways.groupBy("h1", "h2").agg(
            *[F.min(c).alias(c) for c in ("row_no", "k", "pos", "stop", "g1", "g2")],
            F.max(F.struct("k", "pos", "stop", "g1", "g2")).alias("most"),
            F.min("x1").alias("x_low"), F.max("x1").alias("x_high"),
        ), "nodes",
    )
    clash = nodes.where(
        (F.col("x_low") != F.col("x_high"))
        | (F.struct("k", "pos", "stop", "g1", "g2") != F.col("most"))
    )
    if not clash.isEmpty():
        raise ValueError("two beginnings of conversations have the same hash")
    nodes = nodes.drop("most", "x_low", "x_high")

    forks = nodes.where("k > 1").groupBy("g1", "g2").agg(F.count("*").alias("n")).where("n > 1")
    # Saved, so that a turn with very many different answers can be split in the join.
    forks = broadcast_if_small(saved(forks.drop("n"), "forks"), BROADCAST_ROWS)
    begins = nodes.where("k > 1").join(forks, ["g1", "g2"], "left_semi").unionByName(nodes.where("k = 1"))
    begins = saved(begins.select("h1", "h2", F.col("row_no").alias("owner")), "begins")

    step = F.struct("k", "pos", "h1", "h2", (F.col("row_no") == F.col("owner")).alias("owned"))
    ends = ways.groupBy("conv").agg(F.max("k").alias("n_turns"), F.max("stop").alias("stop"))
    steps = ways.join(begins, ["h1", "h2"]).groupBy("conv").agg(
        F.sort_array(F.collect_list(step)).alias("way")
    )
    paths = saved(ends.join(steps, "conv"), "paths")

    # A block reaches to the one that follows it, or as far as the longest conversation in it.
    each = paths.select("stop", "way", F.posexplode("way").alias("i", "at"))
    following = F.get("way", F.col("i") + 1)["pos"]
    sizes = each.groupBy("at.h1", "at.h2").agg(
        F.max(F.coalesce(following, F.col("stop")) - F.col("at.pos")).alias("size")
    )
    key = F.transform(F.slice("way", 1, F.col("i") + 1), lambda s: F.struct(s["h1"].alias("h1"), s["h2"].alias("h2")))
    owned = each.where("at.owned").select(
        "at.h1", "at.h2", F.col("at.pos").alias("pos"), key.alias("path")
    )
    blocks = saved(_placed(owned.join(sizes, ["h1", "h2"]), "path", "size"), "blocks")
    upward = blocks.select(
        F.col("start").alias("block"), "size", F.posexplode("path").alias("depth", "a")
    ).select("block", "size", "depth", F.col("a.h1").alias("h1"), F.col("a.h2").alias("h2"))
    below = saved(upward.groupBy("h1", "h2").agg(F.sum("size").alias("below")), "below")
    laid = saved(
        blocks.join(below, ["h1", "h2"]).select(
            "h1", "h2", F.col("start").alias("block"), "pos", "size",
            (F.col("start") + F.col("below")).alias("visible_to"),
        ), "laid",
    )
    place = F.struct("depth", F.col("begin").alias("start"), (F.col("begin") + F.col("size")).alias("stop"))
    attends = upward.drop("size").join(
        laid.select("h1", "h2", F.col("block").alias("begin"), "size"), ["h1", "h2"]
    ).groupBy("block").agg(F.sort_array(F.collect_list(place)).alias("attends"))
    named = laid.select("block", F.col("size").alias("length")).join(attends, "block").select(
        "block", "length", F.col("attends")[0]["start"].alias("tree"),
        F.transform("attends", lambda a: F.struct(a["start"].alias("start"), a["stop"].alias("stop"))).alias("attends"),
    )

    # Where the blocks on the way of a conversation lie.
    spot = F.struct("pos", "block", "visible_to")
    ways_laid = saved(
        paths.select("conv", F.explode("way").alias("at"))
        .select("conv", F.col("at.h1").alias("h1"), F.col("at.h2").alias("h2"))
        .join(laid, ["h1", "h2"]).groupBy("conv").agg(F.sort_array(F.collect_list(spot)).alias("way")),
        "laid-ways",
    )
    last = F.element_at("way", -1)
    ended = paths.drop("way").join(ways_laid, "conv").select(
        F.col("conv.id").alias("conv_id"), "n_turns", last["block"].alias("block"),
        (last["block"] + F.col("stop") - last["pos"]).alias("stop"),
    )
    first = turns.select("row_no", "conv", "piece", "chars", "loss_start", "loss_end")
    own = F.element_at(F.filter("way", lambda s: s["pos"] <= F.col("pos")), -1)
    emitted = nodes.select("row_no", "pos").join(first, "row_no").join(ways_laid, "conv").select(
        "pos", own.alias("own"), "piece", "chars", "loss_start", "loss_end"
    ).select(
        "own.block", (F.col("own.block") + F.col("pos") - F.col("own.pos")).alias("start"),
        F.col("chars").alias("length"), F.col("pos").alias("position"), "own.visible_to", "piece",
        "loss_start", "loss_end",
    )
    return Forest(saved(emitted, "emitted"), saved(named, "named"), saved(ended, "ends"))


# ---- reading back ---------------------------------------------------------------

def read_back(forest: Forest) -> DataFrame:
    """``conv_id, position, piece, loss_start, loss_end`` per turn of each conversation, from the
    places that its end attends to."""
    ends = forest.ends.select(
        F.struct("conv_id").alias("conv"), F.col("block").alias("last"), F.col("stop").alias("end")
    )
    seen = ends.join(forest.blocks, F.col("last") == F.col("block")).select(
        "conv", "end", F.explode("attends").alias("a")
    ).select("conv", "end", F.col("a.start").alias("block"))
    return seen.join(forest.nodes, "block").where(F.col("start") < F.col("end")).select(
        F.col("conv.conv_id").alias("conv_id"), "position", "piece", "loss_start", "loss_end"
    )


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` per conversation
    of :func:`read_back`, turn by turn, without holding a conversation in memory."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = StructType.fromDDL(
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint"
    )

    def summed(batches):
        current = kind = None
        for batch in batches:
            done, kind = [], batch.schema.field(0).type
            for conv, _, piece, start, stop in zip(*[c.to_pylist() for c in batch.columns]):
                if current is None or conv != current[0]:
                    done += [current] if current else []
                    current = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_turn(piece)
                current[1] += 1
                current[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if start is not None:
                    learnt = unescaped(piece[start:stop])
                    current[3] += len(learnt)
                    current[4].update(learnt.encode("utf-8", "surrogatepass"))
                current[5] += len(piece)
            yield rows(done, kind)
        if current:
            yield rows([current], kind)

    def rows(done, kind):
        columns = list(zip(*[(c, n, a.hexdigest(), m, b.hexdigest(), f) for c, n, a, m, b, f in done]))
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns or [[]] * 6, types)], schema.names
        )

    # No turn is empty, so positions settle the order.
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return dealt.select("conv_id", "position", "piece", "loss_start", "loss_end").mapInArrow(
        summed, schema
    )
