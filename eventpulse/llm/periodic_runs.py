"""Periodic runs of words, by a dictionary of basic factors.

Every stretch of ``2**k`` words gets a name; a name of twice the length is made of two names. For
each length, two occurrences of a name that follow each other within twice that length give a
distance, and three at equal distances, an arithmetic progression, propose it as a period. Each
proposal is extended to both sides as long as words that far apart are the same; what is proposed
from several places or lengths is kept once.

A run of at least four periods has a progression of its own period at the first length that reaches
the period: its words there recur one period later, no sooner, and the third occurrence still ends
within the run. So every run is proposed, and no period is that is not the smallest one.

Names are given to a batch of texts at once; a stretch that does not recur within its text is
dropped before the next length, so that ordinary text costs a few lengths only. Memory grows with
the longest text and a bounded batch.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventpulse.llm._common import col

MIN_WORDS, MIN_PERIODS = 6, 4
BATCH_WORDS = 1 << 18

Run = tuple[int, int, int]  # start, length, period


def _reach(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch of places around ``at`` whose words recur one period later."""
    stop, step, right = len(words) - period, 16, at
    while right < stop:
        part = slice(right, min(right + step, stop))
        differ = words[part] != words[part.start + period:part.stop + period]
        first = int(differ.argmax())
        if differ[first]:
            right += first
            break
        right, step = part.stop, step * 2
    left, step = at, 16
    while left > 0:
        part = slice(max(left - step, 0), left)
        differ = (words[part] != words[part.start + period:part.stop + period])[::-1]
        last = int(differ.argmax())
        if differ[last]:
            left -= last
            break
        left, step = part.start, step * 2
    return left, right


def find_runs(
    words: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
) -> list[Run]:
    """All runs of word numbers, by start, then period; negative numbers part the texts.

    Complete for ``min_periods`` of four or more. A negative number must not occur twice.
    """
    if min_periods < 4:
        raise ValueError("runs of fewer than four periods may have no progression of three")
    n, length = len(words), 1
    at = np.flatnonzero(words >= 0)
    key, found = words[at], set()
    while len(at):
        order = np.argsort(key, kind="stable")
        place, key = at[order], key[order]
        same = key[1:] == key[:-1]
        gap = np.zeros(n, np.int64)  # to the next occurrence, where that is near
        distance = place[1:] - place[:-1]
        near = same & (distance <= 2 * length)
        gap[place[:-1][near]] = distance[near]
        for start, period in _proposals(gap):
            # Part of a run that was found from an earlier place of this or a shorter length.
            left, right = _reach(words, start, period)
            if right - left + period >= max(min_words, min_periods * period):
                found.add((left, right - left + period, period))
        names = np.full(n, -1, np.int64)
        again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        numbers = np.cumsum(np.concatenate([[0], ~same]))
        names[place[again]] = numbers[again]
        at = at[(names[at] >= 0) & (at + length < n)]
        at = at[names[at + length] >= 0]
        key = names[at] * (n + 1) + names[at + length]
        length *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def _proposals(gap: np.ndarray) -> list[tuple[int, int]]:
    """Beginnings of progressions of three with their distance; of neighbours with the same
    distance, and of one progression, the first only."""
    first = np.flatnonzero(gap)
    second = first + gap[first]
    first = first[gap[second] == gap[first]]
    opens = np.zeros(len(gap) + 1, np.int64)  # one to the right, so that place -1 is empty
    opens[first + 1] = gap[first]
    period = gap[first]
    before = first - period
    earlier = np.where(before >= 0, gap[np.maximum(before, 0)], 0)
    new = (opens[first] != period) & (earlier != period)
    return list(zip(first[new].tolist(), period[new].tolist()))


def strongest(runs: list[Run]) -> Run | None:
    """The run of most periods, by exact fractions; of equal ones the first, then the shortest
    period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period only."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:n]) == 0


def _scan(texts: list[list[bytes]], min_words: int, min_periods: int) -> Iterator[list[Run]]:
    """The runs of each text, given as words."""
    numbers: defaultdict = defaultdict(count().__next__)
    parts, bounds = [], [0]
    for i, words in enumerate(texts):
        parts += [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), [-1 - i]]
        bounds.append(bounds[-1] + len(words) + 1)
    for i in range(len(texts)):  # a word of another text is another word
        parts[2 * i] += i * len(numbers)
    runs = find_runs(np.concatenate(parts), min_words, min_periods)
    k = 0
    for i in range(len(texts)):
        own = []
        while k < len(runs) and runs[k][0] < bounds[i + 1]:
            own.append((runs[k][0] - bounds[i], *runs[k][1:]))
            k += 1
        yield own


_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])


def periodic_runs(
    table: DataFrame,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    min_periods: int = MIN_PERIODS,
) -> DataFrame:
    """``doc_id, n_words, runs, strongest, collapsed`` per row of the table.

    Words are what white space of ASCII parts, numbered from 0. ``runs`` are the stretches of words
    with smallest period ``period``, of at least ``min_words`` words and ``min_periods`` periods,
    that no neighbouring word extends; ``strongest`` is the one of most periods, or null.
    ``collapsed`` are the words, joined by one blank, without those that lie behind the first
    period of a run. A null text and an empty one have no words and no runs. Rows with the same id
    are kept apart; texts of any length are read whole; other columns are not looked at; an empty
    table gives no rows.
    """
    rows = table.select(
        col(id_column).alias("doc_id"), col(text).cast("string").cast("binary").alias("text")
    )

    def found(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            start, held, size = 0, [], 0
            for i in range(batch.num_rows):
                held.append((texts[i].as_py() or b"").split())
                size += len(held[-1])
                if size >= BATCH_WORDS or i + 1 == batch.num_rows:
                    yield answer(ids.slice(start, len(held)), held)
                    start, held, size = i + 1, [], 0

    def answer(ids, texts):
        runs, best, collapsed = [], [], []
        for words, own in zip(texts, _scan(texts, min_words, min_periods)):
            first = strongest(own)
            if own:
                words = [words[i] for i in np.flatnonzero(kept_words(len(words), own)).tolist()]
            runs.append([dict(zip(("start", "length", "period"), r)) for r in own])
            best.append(first and dict(zip(("start", "length", "period"), first)))
            collapsed.append(b" ".join(words))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([len(w) for w in texts], pa.int64()), pa.array(runs, pa.list_(_RUN)),
             pa.array(best, _RUN), pa.array(collapsed, pa.binary())],
            ["doc_id", "n_words", "runs", "strongest", "collapsed"],
        )

    run = "struct<start: bigint, length: bigint, period: bigint>"
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(
        found,
        f"doc_id {kind}, n_words bigint, runs array<{run}>, strongest {run}, collapsed binary",
    )
    return out.withColumn("collapsed", out["collapsed"].cast("string"))
