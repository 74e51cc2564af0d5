"""Grouping of spelling variants by blocked Gram matrices.

Words are counted first, so that only distinct ones are compared. Each becomes a vector of letter
counts, folded to ``FOLDS`` components. One inserted or deleted letter changes one component by one,
and one replaced letter two at most, so the squared distance of near words is two at most. Products
of a block's vectors with another's, one Gram matrix a pair of blocks, give all squared distances
between them; the few pairs within two are verified letter by letter.

Blocks are of equal length, and only adjacent lengths meet. They are cut further by the same
argument: letters fall into ``CLASSES`` classes, a block holds the words of equal counts per class,
and a word meets its own block, those with one letter moved between two classes, and those with one
letter more. No pair is missed, and the work grows with the sizes of the few blocks that meet
instead of with the square of the vocabulary. Blocks of many words are cut into chunks by hash,
within a bound on words and letters, and every pair of chunks is one row of work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventpulse.llm._common import col, lower_ascii, saved

LETTERS = r"a-zÀ-ÿ"  # after lower-casing A-Z
MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
FOLDS, CLASSES = 64, 5
CHUNK_WORDS, CHUNK_LETTERS = 1024, 1 << 19
VERIFIED_AT_ONCE = 1 << 22  # letters


def letter_runs(
    table: DataFrame, *, id_column: str = "doc_id", text: str = "text",
    min_letters: int = MIN_LETTERS, letters: str = LETTERS,
) -> DataFrame:
    """``doc_id, run`` per maximal run of at least ``min_letters`` letters of the texts, A-Z in
    lower case. Null and empty texts have none; texts are read whole."""
    runs = F.regexp_extract_all(
        lower_ascii(col(text)), F.lit(f"[{letters}]{{{min_letters},}}"), F.lit(0)
    )
    return table.select(col(id_column).alias("doc_id"), F.explode(runs).alias("run"))


def word_counts(
    words: DataFrame, word: str = "word", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT
) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    long = words.select(col(word).alias("word")).where(F.length("word") >= min_letters)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def letter_codes(words: str, length: int) -> np.ndarray:
    """A row of code points per word, of words of one length written one after the other."""
    return np.frombuffer(words.encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, length)


def letter_counts(codes: np.ndarray, folds: int = FOLDS) -> np.ndarray:
    """A row of letter counts per word, exact as floating-point numbers."""
    rows = np.arange(len(codes))[:, None] * folds
    flat = np.bincount((rows + codes % folds).ravel(), minlength=len(codes) * folds)
    # Squared distances are made of sums below 2**24, where single precision is exact.
    return flat.reshape(-1, folds).astype(np.float32 if codes.shape[1] <= 2048 else np.float64)


def one_edit(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one replaced letter, or one more on the right."""
    length = left.shape[1]
    if right.shape[1] == length:
        return (left != right).sum(1) == 1
    ahead, behind = left == right[:, :length], left == right[:, 1:]
    prefix = np.where(ahead.all(1), length, (~ahead).argmax(1))
    suffix = np.where(behind.all(1), length, (~behind[:, ::-1]).argmax(1))
    return prefix + suffix >= length


def near_in_blocks(
    left: np.ndarray, right: np.ndarray, same: bool, folds: int = FOLDS
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of near words of two blocks; each pair once where both are the ``same`` block."""
    a, b = letter_counts(left, folds), letter_counts(right, folds)
    apart = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    close = apart <= 2
    i, j = np.nonzero(np.triu(close, 1) if same else close)
    step = max(1, VERIFIED_AT_ONCE // right.shape[1])
    parts = [slice(at, at + step) for at in range(0, len(i), step)]
    good = [one_edit(left[i[p]], right[j[p]]) for p in parts]
    good = np.concatenate(good) if good else np.zeros(0, bool)
    return i[good], j[good]


def _with_classes(counts: DataFrame, classes: int) -> DataFrame:
    """Add the number of letters per class."""

    def classed(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            keys = [
                np.bincount(letter_codes(w, 1).ravel() % classes, minlength=classes).tolist()
                for w in words
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.list_(pa.int32()))], ["word", "n", "block"]
            )

    return counts.select("word", "n").mapInArrow(
        classed, "word string, n bigint, block array<int>"
    )


def _chunks(counts: DataFrame, classes: int) -> DataFrame:
    """``block, chunk, length, words, ns``: words of equal length, one after the other."""
    words = saved(_with_classes(counts, classes), "words")
    sizes = words.groupBy("block").agg(
        F.greatest(
            F.ceil(F.count("*") / CHUNK_WORDS), F.ceil(F.sum(F.length("word")) / CHUNK_LETTERS)
        ).alias("chunks")
    )
    placed = words.join(sizes, "block").withColumn(
        "chunk", F.pmod(F.xxhash64("word"), F.col("chunks"))
    )
    members = placed.groupBy("block", "chunk").agg(
        F.collect_list(F.struct("word", "n")).alias("m")
    )
    return members.select(
        "block", "chunk", F.length(F.col("m")[0]["word"]).alias("length"),
        F.array_join(F.col("m")["word"], "").alias("words"), F.col("m")["n"].alias("ns"),
    )


def _moves(classes: int) -> Column:
    """From a block to itself, and to one of each two blocks that may hold near words."""
    steps = [[0] * classes]
    for i in range(classes):
        longer = [int(k == i) for k in range(classes)]
        steps.append(longer)
        steps += [[x - int(k == j) for k, x in enumerate(longer)] for j in range(i)]
    return F.expr("array(" + ", ".join(f"array({', '.join(map(str, s))})" for s in steps) + ")")


def near_pairs(counts: DataFrame, classes: int = CLASSES, folds: int = FOLDS) -> DataFrame:
    """``word, near, near_n``: both ways, every pair of distinct words one edit apart."""
    chunks = saved(_chunks(counts, classes), "chunks")
    target = F.transform(
        _moves(classes), lambda m: F.zip_with("block", m, lambda x, d: (x + d).cast("int"))
    )
    left = chunks.select(
        F.explode(target).alias("target"), F.col("block").alias("own"),
        *[F.col(c).alias(f"l_{c}") for c in ("chunk", "length", "words", "ns")],
    ).where(F.array_min("target") >= 0)
    met = left.join(chunks, F.col("target") == F.col("block")).where(
        (F.col("own") != F.col("block")) | (F.col("l_chunk") <= F.col("chunk"))
    )
    pairs = met.select(
        ((F.col("own") == F.col("block")) & (F.col("l_chunk") == F.col("chunk"))).alias("same"),
        "l_length", "l_words", "l_ns", "length", "words", "ns",
    )

    def compared(batches):
        for batch in batches:
            for same, l_length, l_words, l_ns, length, words, ns in zip(
                *[c.to_pylist() for c in batch.columns]
            ):
                left, right = letter_codes(l_words, l_length), letter_codes(words, length)
                i, j = near_in_blocks(left, right, same, folds)
                if len(i):
                    mine = [l_words[k * l_length:(k + 1) * l_length] for k in i.tolist()]
                    its = [words[k * length:(k + 1) * length] for k in j.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mine + its, pa.string()), pa.array(its + mine, pa.string()),
                         pa.array(np.concatenate([np.array(ns)[j], np.array(l_ns)[i]]), pa.int64())],
                        ["word", "near", "near_n"],
                    )

    return pairs.mapInArrow(compared, "word string, near string, near_n bigint")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``, following forms to the last by pointer jumping.

    A form is more frequent than its word by a factor, so there are no circles, and chains are as
    long as the logarithm of the largest count; the rounds are the logarithm of that.
    """
    jumps = forms.select("word", F.col("form").alias("root"))
    while True:
        jumps = saved(jumps, "roots")
        onward = jumps.select(F.col("word").alias("at"), F.col("root").alias("next"))
        joined = jumps.join(onward, F.col("root") == F.col("at"), "left")
        if joined.where("next IS NOT NULL").isEmpty():
            return jumps
        jumps = joined.select("word", F.coalesce("next", "root").alias("root"))


def group_variants(
    counts: DataFrame, ratio: int = RATIO, classes: int = CLASSES, folds: int = FOLDS
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per row of ``word, n``.

    Two words are near when one inserted, deleted or replaced code point leads from one to the
    other. A word's ``form`` is its most frequent near word, of equally frequent ones the smallest
    by code points, if that is at least ``ratio`` times as frequent; else null. ``root`` is reached
    by following forms to the last. ``n_near`` is the number of near words. Words must be distinct
    and not empty, of any length and alphabet, and counts positive; ``ratio`` must be above one. A
    null word is left out; no rows give none; other columns are not looked at.
    """
    if ratio <= 1:
        raise ValueError("a form must be more frequent than its word")
    counts = saved(counts.select("word", "n").where("word IS NOT NULL"), "counts")
    best = near_pairs(counts, classes, folds).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"),
    ).select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))
    follows = F.col("form_n") >= ratio * F.col("n")
    named = saved(
        counts.join(best, "word", "left").select(
            "word", F.when(follows, F.col("form")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(follows, F.col("form_n")).alias("form_n"),
        ), "named",
    )
    roots = _roots(named.where("form IS NOT NULL"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
