"""Repeated runs of lines by a suffix array made by prefix doubling; later copies are deleted.

The lines of all documents, in order of the documents, are one sequence of line ids. A suffix
begins at every line, and never reaches beyond its document. Prefix doubling sorts suffixes by
their first 1, 2, 4, ... lines: the rank by ``2h`` lines comes from the sorted pairs of the ranks
by ``h`` lines, at the position and ``h`` further on. Every step is a grouping, a global sort of
the distinct pairs, and a join. Suffixes whose first lines occur once are settled and leave, and
the doubling ends with the longest run that has to be told apart.

All suffixes that begin with the same ``m`` lines are an interval of the suffix array, with a
longest common prefix of ``m`` lines at least; two ranks, of the first and the last ``2 ** k`` of
these lines, identify it. A run that counts has ``min_words`` words or more. Wherever a run occurs
again, each of its lines lies in a shortest run that counts, from that line on or up to it, inside
the run. So these shortest runs are looked up, and where their interval begins earlier in the
corpus the lines are deleted; adjoining and overlapping ones add up to the maximal repeated run.

Lines are grouped by digest and by rank, with counts and minima combined before each shuffle. The
joins that lead ranks back to positions are of shuffled tables, so adaptive execution can split
them where one line is a third of all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from eventpulse.llm._common import col, free_name, numbered, saved

MIN_WORDS = 30
BROADCAST_RUNS = 1_000_000


def line_table(docs: DataFrame) -> DataFrame:
    """``pos, row_no, line_no, digest, words`` per line of ``row_no, id, text``.

    ``pos`` grows along the corpus, in order of the ids, and by one from line to line of a document.
    """
    lines = F.transform(
        F.split("text", "\n", -1),
        lambda x: F.struct(
            F.unhex(F.sha2(x, 256)).alias("digest"), F.regexp_count(x, F.lit(r"\S+")).alias("words")
        ),
    )
    # Cut once and saved: a global sort reads what it sorts twice, for its bounds and for its rows.
    cut = saved(docs.where("text IS NOT NULL").select("id", "row_no", lines.alias("lines")), "cut")
    ordered = cut.orderBy(F.col("id").asc_nulls_last(), "row_no")
    each = ordered.select("row_no", F.posexplode("lines").alias("line_no", "l"))
    return saved(
        numbered(each, "pos").select("pos", "row_no", "line_no", "l.digest", "l.words"), "lines"
    )


def _ranked(occurrences: DataFrame, keys: list[str]) -> DataFrame:
    """Occurrences with the rank of their key among the keys that occur more than once."""
    repeated = occurrences.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)
    # Numbers given after a global sort grow with the keys.
    names = saved(numbered(repeated.orderBy(*keys), "rank"), "ranks")
    kept = [c for c in occurrences.columns if c not in keys]
    return saved(occurrences.join(names, keys).select(*kept, "rank"), "ranked")


def doubled(ranked: DataFrame, h: int) -> DataFrame:
    """Ranks by ``2h`` lines, from ``pos, row_no, rank`` by ``h`` lines."""
    later = ranked.select(
        (F.col("pos") - h).alias("pos"), "row_no", F.col("rank").alias("second")
    )
    pairs = ranked.select("pos", "row_no", F.col("rank").alias("first")).join(
        later, ["pos", "row_no"]
    )
    return _ranked(pairs, ["first", "second"])


def shortest_runs(live: DataFrame, min_words: int) -> DataFrame:
    """``row_no, pos, m``: for each line, the shortest runs of ``m`` lines that count, beginning or
    ending with it, among consecutive lines of ``live`` (``row_no, pos, words``)."""
    per_doc = live.groupBy("row_no").agg(
        F.sort_array(F.collect_list(F.struct("pos", "words"))).alias("l")
    ).select("row_no", F.col("l.pos").alias("pos"), F.col("l.words").alias("words"))

    def runs(batches):
        for batch in batches:
            rows, starts, sizes = [], [], []
            for row in batch.to_pylist():
                pos, words = np.array(row["pos"], np.int64), np.array(row["words"], np.int64)
                for part in np.split(np.arange(len(pos)), np.flatnonzero(np.diff(pos) != 1) + 1):
                    upto = np.concatenate([[0], np.cumsum(words[part])])
                    n = len(part)
                    last = np.searchsorted(upto, upto[:-1] + min_words)  # first end that suffices
                    first = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1
                    found = {(i, e - i) for i, e in enumerate(last.tolist()) if e <= n}
                    found |= {(s, e + 1 - s) for e, s in enumerate(first.tolist()) if s >= 0}
                    for i, m in found:
                        rows.append(row["row_no"])
                        starts.append(int(pos[part[i]]))
                        sizes.append(m)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(starts, pa.int64()),
                 pa.array(sizes, pa.int32())], ["row_no", "pos", "m"],
            )

    return per_doc.mapInArrow(runs, "row_no bigint, pos bigint, m int")


def later_copies(lines: DataFrame, min_words: int) -> DataFrame:
    """``row_no, pos, m``: runs of lines that occurred before, together all lines to delete."""
    ranked = _ranked(lines, ["digest"])
    runs = saved(shortest_runs(ranked, min_words), "runs")
    longest = runs.agg(F.max("m")).first()[0] or 0
    ranked, h, found = ranked.select("row_no", "pos", "rank"), 1, None
    while h <= longest:
        # Runs of h to 2h - 1 lines: the ranks by h lines of their beginning and of their end.
        here = runs.where((F.col("m") >= h) & (F.col("m") < 2 * h))
        last = ranked.select(
            "row_no", F.col("pos").alias("end"), F.col("rank").alias("second")
        )
        named = (
            here.withColumn("end", F.col("pos") + F.col("m") - h)
            .join(ranked.withColumnRenamed("rank", "first"), ["row_no", "pos"])
            .join(last, ["row_no", "end"])
        )
        named = saved(named.select("row_no", "pos", "m", "first", "second"), "named")
        interval = ["m", "first", "second"]
        earliest = saved(
            named.groupBy(*interval).agg(F.min("pos").alias("at"), F.count("*").alias("n"))
            .where("n > 1").drop("n"), "intervals",
        )
        copies = named.join(earliest, interval).where("pos > at").select("row_no", "pos", "m")
        found = copies if found is None else found.unionByName(copies)
        if 2 * h <= longest:
            ranked = doubled(ranked, h)
        h *= 2
    return runs.limit(0) if found is None else found


def merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of intervals (first line, number of lines); adjoining ones become one."""
    out: list[list[int]] = []
    for start, m in sorted(intervals):
        if out and start <= out[-1][0] + out[-1][1]:
            out[-1][1] = max(out[-1][1], start + m - out[-1][0])
        else:
            out.append([start, m])
    return [tuple(x) for x in out]


def without(text: str, runs: list[tuple[int, int]]) -> str:
    """The text without the lines of some disjoint runs, which are in order."""
    if not runs:
        return text
    lines, kept, at = text.split("\n"), [], 0
    for start, m in runs:
        kept += lines[at:start]
        at = start + m
    return "\n".join(kept + lines[at:])


RUNS = pa.list_(pa.struct([("first_line", pa.int32()), ("n_lines", pa.int32())]))


def delete_repeated_runs(
    table: DataFrame, *, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
    runs_column: str = "deleted_runs",
) -> DataFrame:
    """All rows and columns of ``table`` with later copies of repeated runs of lines deleted from
    ``text``, and the deleted runs (first line from 0, number of lines) in ``runs_column``.

    A run counts from ``min_words`` words on. The first occurrence, in order of id and line, stays;
    a repetition within one document counts too. Null ids come last, and rows of one id follow each
    other in an order of the reader's. A null text stays null; a text may become empty. A column
    named like ``runs_column`` is an error. Empty tables are fine.
    """
    if runs_column.lower() in {c.lower() for c in table.columns}:
        raise ValueError(f"the table has a column {runs_column!r} already")
    number = free_name(table, "row_no")
    docs = saved(numbered(table, number), "numbered")
    lines = line_table(docs.select(
        col(number).alias("row_no"), col(id_column).alias("id"), col(text).alias("text")
    ))
    copies = later_copies(lines, min_words)
    first_pos = lines.where("line_no = 0").select("row_no", F.col("pos").alias("begin"))
    listed = copies.join(first_pos, "row_no").groupBy(F.col("row_no").alias("_listed")).agg(
        F.collect_list(F.struct((F.col("pos") - F.col("begin")).cast("int").alias("s"), "m")).alias("runs")
    )
    # So few runs are broadcast, and no text is shuffled; beyond that both sides are.
    listed = saved(listed, "listed")
    n_runs = listed.agg(F.sum(F.size("runs"))).first()[0] or 0
    listed = F.broadcast(listed) if n_runs <= BROADCAST_RUNS else listed
    names, at = [*docs.columns, runs_column], docs.columns.index(text)
    joined = docs.join(
        listed, col(number) == F.col("_listed"), "left"
    ).select(*[col(c) for c in docs.columns], "runs")

    def clean(batches):
        for batch in batches:
            runs = [
                merged([(r["s"], r["m"]) for r in own]) if own else []
                for own in batch.column(len(names) - 1).to_pylist()
            ]
            columns = list(batch.columns)
            if any(runs):
                texts = batch.column(at).to_pylist()
                columns[at] = pa.array(
                    [without(t, r) if r else t for t, r in zip(texts, runs)], batch.column(at).type
                )
            columns[-1] = pa.array(
                [[dict(first_line=s, n_lines=m) for s, m in r] for r in runs], RUNS
            )
            yield pa.RecordBatch.from_arrays(columns, names)

    run = T.StructType().add("first_line", T.IntegerType()).add("n_lines", T.IntegerType())
    schema = T.StructType([*docs.schema, T.StructField(runs_column, T.ArrayType(run))])
    return joined.mapInArrow(clean, schema).drop(number)
