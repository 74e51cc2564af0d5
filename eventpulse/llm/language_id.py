"""Language of a text by interpolated Kneser-Ney character models, one per language.

A text is read as lower-case letters with single blanks between words. For every language the
model holds the 4-grams, 3-grams and 2-grams seen in training with their interpolated Kneser-Ney
probabilities: absolute discounting with a discount per order from the counts of counts, and
continuation counts below the highest order. All languages share one table per order, an array of
sorted n-gram hashes with the languages that have each, so that a text is looked up once whatever
the number of languages. The language of the lowest cross-entropy per character wins.

A text is rejected when its cross-entropy lies further above what texts of the winning language
have than their spread allows at its length. Mean and spread come from distinct labelled texts that
the model was not fitted on; the spread of a language with few of them is drawn towards that of all
languages. How many spreads are allowed is a quantile of what these texts have themselves.

Counting is a Spark aggregation over the labelled texts: tasks emit distinct n-grams with counts.
All counts of the highest order reach the driver, some languages at a time, and all n-grams are in
the model: what bounds it is the number of labelled rows per language.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventpulse.llm._common import broadcast_if_small, col, saved

UNKNOWN = "und"
# Bound of what is fitted: labelled rows per language.
TRAIN_ROWS = 40_000
# Languages are gathered together up to so many 4-grams, and one by one beyond.
GRAMS_AT_ONCE = 2_000_000
# Letters times languages that are looked up at once.
LOOKED_UP = 4_000_000
# N-grams that a task holds before they are added up, 8 bytes each and as much again for sorting.
COUNTED_AT_ONCE = 4_000_000
# So many labels at most are broadcast with the hash at which their rows are cut.
MAX_LANGUAGES = 10_000
# Of the labelled rows, one in this many calibrates and is not counted.
CALIBRATION = 8
# Share of the calibrating texts that lie above the cut, and the cut, in spreads above the mean of
# a language, where fewer texts than LEAST calibrate.
REJECTED_SHARE = 0.001
LEAST = 30
REJECT_AT = 8.0
# The common spread counts as so many texts of a language; it is in nats where no language has two.
COMMON_TEXTS = 8
COMMON_SPREAD = 0.2
# Share of a letter that no language has seen, spread over so many letters.
ALPHABET = 65_536

_BLANK = 32


def _letter_table() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(1 << 16)])


def letters(text: str | None, table: np.ndarray) -> np.ndarray:
    """Codes of the lower-case letters with one blank around words; empty without a letter.

    Codes beyond 16 bits fall on the replacement character if they are letters.
    """
    if not text:
        return np.empty(0, np.uint64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    if codes.max(initial=0) >= 1 << 16:
        high = np.flatnonzero(codes >= 1 << 16)
        codes = codes.copy()
        alpha = np.array([chr(c).isalpha() for c in codes[high].tolist()])
        codes[high] = np.where(alpha, 0xFFFD, _BLANK)
        is_letter = table[codes]
        is_letter[high] = alpha  # a replacement character of the text itself is no letter
    else:
        is_letter = table[codes]
    if not is_letter.any():
        return np.empty(0, np.uint64)
    codes = np.where(is_letter, codes, _BLANK).astype(np.uint64)
    kept = np.concatenate([[True], is_letter[1:] | is_letter[:-1]])
    codes = codes[kept]
    if codes[0] != _BLANK:
        codes = np.concatenate([[_BLANK], codes]).astype(np.uint64)
    if codes[-1] != _BLANK:
        codes = np.append(codes, np.uint64(_BLANK))
    return codes


def grams4(codes: np.ndarray) -> np.ndarray:
    """Every letter with the three before it in one word of 64 bits; blanks stand before a text."""
    c = np.concatenate([np.full(2, _BLANK, np.uint64), codes])
    s = np.uint64(16)
    return ((c[:-3] << s | c[1:-2]) << s | c[2:-1]) << s | c[3:]


def gram_hash(grams: np.ndarray) -> np.ndarray:
    """A mixing of 64 bits that no two words share, so that equal hashes are equal n-grams."""
    h = grams ^ (grams >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass(frozen=True)
class Table:
    """Sorted hashes of the n-grams of one order, with a run of languages and values per n-gram."""

    hashes: np.ndarray
    begin: np.ndarray
    languages: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(per_language: list[tuple[np.ndarray, np.ndarray]]) -> Table:
        """From the distinct n-grams of each language and their values."""
        hashes = gram_hash(np.concatenate([grams for grams, _ in per_language]))
        order = np.argsort(hashes, kind="stable")
        hashes, begin = np.unique(hashes[order], return_index=True)
        sizes = [len(grams) for grams, _ in per_language]
        languages = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
        values = np.concatenate([values for _, values in per_language])[order]
        return Table(hashes, np.append(begin, len(order)), languages, values)

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the n-grams are in which languages, and the values there."""
        wanted = gram_hash(grams)
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        row = np.flatnonzero(self.hashes[at] == wanted)
        first, size = self.begin[at[row]], np.diff(self.begin)[at[row]]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        entry = np.repeat(first, size) + within
        return np.repeat(row, size), self.languages[entry], self.values[entry]


@dataclass(frozen=True)
class Model:
    """Log probabilities per order and language, and what calibrates the rejection.

    ``backoff[n]`` has the log weight that a context of ``n`` letters leaves to the next order.
    """

    languages: tuple[str, ...]
    grams: dict[int, Table]
    backoff: dict[int, Table]
    floor: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    own_spread: np.ndarray
    reject_at: float

    def sent(self, spark: SparkSession):
        """A broadcast of the model, made of arrays only, as workers may lack this package."""
        return spark.sparkContext.broadcast(asdict(self))

    @staticmethod
    def received(fields: dict) -> Model:
        tables = {k: {n: Table(**t) for n, t in fields[k].items()} for k in ("grams", "backoff")}
        return Model(**{**fields, **tables})

    def costs(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per language, the sum over the letters of the negative log probability, and of its square."""
        cost, square = self.costs_of([codes])
        return cost[0], square[0]

    def costs_of(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The costs of texts of two codes or more, a row per text; they do not depend on each other."""
        at_once = max(1024, LOOKED_UP // len(self.languages))
        cost, square = np.zeros((2, len(texts), len(self.languages)))
        held, size = [], 0

        def add():
            begin = np.cumsum([0, *(len(g) for _, g in held[:-1])])
            distinct, where = np.unique(np.concatenate([g for _, g in held]), return_inverse=True)
            text = [t for t, _ in held]
            for k, logp in enumerate(self._order(distinct, 4).T):
                own = logp[where]
                cost[text, k] -= np.add.reduceat(own, begin)
                square[text, k] += np.add.reduceat(np.square(own), begin)

        for t, codes in enumerate(texts):
            grams = grams4(codes)
            for a in range(0, len(grams), at_once):  # of a text, a piece at a time
                part = grams[a:a + at_once]
                if held and (a or size + len(part) > at_once):
                    add()
                    held, size = [], 0
                held.append((t, part))
                size += len(part)
        if held:
            add()
        return cost, square

    def _order(self, grams: np.ndarray, n: int) -> np.ndarray:
        """Log probabilities of distinct n-grams of 4 letters' width, a column per language."""
        if n == 1:
            logp = np.repeat(self.floor[None], len(grams), 0)
        else:  # what a language has not seen costs what it does after backing off
            lower, where = np.unique(
                grams & np.uint64((1 << 16 * (n - 1)) - 1), return_inverse=True
            )
            logp = self._order(lower, n - 1)[where]
            contexts, where = np.unique(grams >> np.uint64(16), return_inverse=True)
            left = np.zeros((len(contexts), len(self.languages)))
            row, language, value = self.backoff[n - 1].find(contexts)
            left[row, language] = value
            logp += left[where]
        row, language, value = self.grams[n].find(grams)
        logp[row, language] = value
        return logp


def _kneser_ney(grams: np.ndarray, counts: np.ndarray) -> tuple[dict, dict, float]:
    """Probabilities of one language from its distinct 4-grams and their counts."""
    per_order = {4: (grams, counts.astype(float))}
    for n in (3, 2, 1):  # how many different letters stand before an n-gram
        higher = per_order[n + 1][0] & np.uint64((1 << 16 * n) - 1)
        per_order[n] = tuple(np.unique(higher, return_counts=True))
    ones, twos = (np.sum(per_order[1][1] == k) for k in (1, 2))
    d1 = ones / (ones + 2 * twos) if ones else 0.5
    keys, c = per_order[1]
    total = c.sum()
    floor = d1 * len(keys) / total / ALPHABET
    p = {1: (keys, np.maximum(c - d1, 0) / total + floor)}
    backoff = {}
    for n in (2, 3, 4):
        keys, c = per_order[n]
        ones, twos = (np.sum(c == k) for k in (1, 2))
        d = min(0.95, ones / (ones + 2 * twos)) if ones else 0.5
        contexts, where = np.unique(keys >> np.uint64(16), return_inverse=True)
        totals = np.bincount(where, c)
        left = d * np.bincount(where) / totals
        low_keys, low_p = p[n - 1]
        lower = low_p[np.searchsorted(low_keys, keys & np.uint64((1 << 16 * (n - 1)) - 1))]
        p[n] = keys, np.maximum(c - d, 0) / totals[where] + left[where] * lower
        backoff[n - 1] = contexts, left
    return p, backoff, floor


def build(counts: Iterable[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """The model of ``(language, distinct 4-grams, counts)``, not calibrated yet."""
    counts = sorted(counts, key=lambda c: c[0])
    fitted = [_kneser_ney(np.sort(g), c[np.argsort(g)]) for _, g, c in counts]
    languages = tuple(c[0] for c in counts)
    floor = np.log(np.array([f[2] for f in fitted]))
    one = np.ones(len(languages))
    model = Model(languages, {}, {}, floor, one, one, one, REJECT_AT)
    for n in (1, 2, 3, 4):
        if n > 1:
            model.backoff[n - 1] = Table.of([(k, np.log(v)) for k, v in (f[1][n - 1] for f in fitted)])
        model.grams[n] = Table.of([(k, np.log(v)) for k, v in (f[0][n] for f in fitted)])
    return model


def _counted(rows: DataFrame) -> DataFrame:
    """``(lang, gram, n)``: 4-grams of a task's texts, before they are added up."""

    def count(batches):
        table = _letter_table()
        texts: dict[str, list[np.ndarray]] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = letters(text, table)
                if len(codes):
                    texts.setdefault(lang, []).append(grams4(codes))
                    held += len(codes)
                if held >= COUNTED_AT_ONCE:
                    yield from counts(texts)
                    texts, held = {}, 0
        yield from counts(texts)

    def counts(texts):
        for lang, grams in texts.items():
            keys, n = np.unique(np.concatenate(grams), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)],
                ["lang", "gram", "n"],
            )

    counted = rows.mapInArrow(count, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _sampled(rows: DataFrame, per_language: int) -> DataFrame:
    """At most so many rows per language, those of the smallest hash; all where there are fewer.

    The hash at which a language is cut comes from a histogram of hashes, so no language is sorted.
    Where the first cell alone has more rows, it is cut by a histogram of its own. Rows of one
    text and id stay together, and some rows of every language stay.
    """
    cells = 4096
    both = F.xxhash64("text", "id")
    hashed = rows.withColumn("_cell", F.pmod(both, F.lit(cells))).withColumn(
        "_fine", F.col("_cell") * cells + F.pmod(F.shiftright(both, 32), F.lit(cells))
    )

    def cuts(rows: DataFrame, cell: str) -> DataFrame:
        sizes = rows.groupBy("lang", cell).agg(F.count("*").alias("n"))
        upto = sizes.withColumn("_upto", F.expr(
            f"sum(n) OVER (PARTITION BY lang ORDER BY {cell})"
        ))
        return upto.groupBy("lang").agg(
            F.max(F.when(F.col("_upto") <= per_language, F.col(cell))).alias("_last"),
            F.min(cell).alias("_first"),
        )

    cut = saved(cuts(hashed, "_cell"), "cut")
    dense = cut.where("_last IS NULL").select("lang", "_first")
    cut = cut.where("_last IS NOT NULL").select("lang", ((F.col("_last") + 1) * cells).alias("_cut"))
    if not dense.isEmpty():
        within = hashed.join(broadcast_if_small(dense, MAX_LANGUAGES), "lang").where("_cell = _first")
        fine = cuts(within.select("lang", "_fine"), "_fine")
        fine = fine.select("lang", (F.coalesce("_last", "_first") + 1).alias("_cut"))
        cut = saved(cut.unionByName(fine), "cut")
    cut = broadcast_if_small(cut, MAX_LANGUAGES)
    return hashed.join(cut, "lang").where("_fine < _cut").drop("_cell", "_fine", "_cut")


def _gathered(counts: DataFrame):
    """Each language with all its 4-grams and their counts; some languages at a time."""
    sizes = counts.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()
    while sizes:
        some, n = [], 0
        while sizes and (not some or n + sizes[0].n <= GRAMS_AT_ONCE):
            some.append(sizes[0].lang)
            n += sizes.pop(0).n
        place = counts.where(F.col("lang").isin(some)).select(
            (F.array_position(F.array(*map(F.lit, some)), F.col("lang")) - 1).alias("k"), "gram", "n"
        ).toArrow()
        k, gram, n = (place[c].to_numpy() for c in ("k", "gram", "n"))
        order = np.argsort(k, kind="stable")
        ends = np.searchsorted(k[order], np.arange(len(some) + 1))
        for i, name in enumerate(some):
            own = order[ends[i]:ends[i + 1]]
            yield name, gram[own].view(np.uint64), n[own]


def fit(
    labelled: DataFrame, *, id_column: str = "doc_id", text: str = "text", lang: str = "lang",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """A calibrated model from rows with a label; rows without label, text or letters do not count.

    Where nothing is left to fit, the model knows no language and calls every text ``und``.
    """
    rows = labelled.select(
        col(lang).cast("string").alias("lang"), col(text).alias("text"), col(id_column).alias("id")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    rows = _sampled(rows, train_rows)
    fold = F.pmod(F.xxhash64("text"), F.lit(CALIBRATION)) == 0
    counts = saved(_counted(rows.where(~fold).select("lang", "text")), "grams")
    calibrating = rows.where(fold)
    # A language that only has texts of the calibrating fold is fitted on those.
    lost = calibrating.select("lang").distinct().join(counts, "lang", "left_anti")
    lost = broadcast_if_small(saved(lost, "lost"), MAX_LANGUAGES)
    if not lost.isEmpty():
        more = saved(_counted(calibrating.join(lost, "lang", "left_semi").select("lang", "text")), "grams")
        if not counts.isEmpty():  # its own texts do not calibrate it
            calibrating = calibrating.join(lost, "lang", "left_anti")
        counts = counts.unionByName(more)
    gathered = list(_gathered(counts))
    if not gathered:
        none = np.empty(0)
        return Model((), {}, {}, none, none, none, none, REJECT_AT)
    return _calibrated(build(gathered), calibrating.select("lang", "text"))


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """Mean cost per letter by language, its spread between texts and that within a text, and the cut."""
    shared = model.sent(rows.sparkSession)

    def measure(batches):
        table, model = _letter_table(), Model.received(shared.value)
        place = {name: i for i, name in enumerate(model.languages)}
        for batch in batches:
            out = []
            for lang, text, key in zip(*(c.to_pylist() for c in batch.columns)):
                codes = letters(text, table)
                if len(codes) > 1 and lang in place:
                    cost, square = (x[place[lang]] for x in model.costs(codes))
                    n = len(codes) - 1
                    out.append((place[lang], key, n, cost / n, square / n - (cost / n) ** 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate(
                    (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
                )],
                ["k", "key", "n", "cost", "var"],
            )

    keyed = rows.select("lang", "text", F.xxhash64("text").alias("key"))
    measured = keyed.mapInArrow(measure, "k int, key bigint, n bigint, cost double, var double")
    # Copies count once.
    measured = saved(measured.where("n >= 20").dropDuplicates(["k", "key"]), "measured")
    found = measured.groupBy("k").agg(
        F.count("*").alias("texts"), F.avg("cost").alias("mean"), F.var_samp("cost").alias("var"),
        F.avg("var").alias("own"),
    ).collect()  # a row per language
    size = len(model.languages)
    # Without calibration nothing is rejected.
    mean, spread, own = np.full(size, math.inf), np.ones(size), np.ones(size)
    freedom = sum(r.texts - 1 for r in found)
    common = COMMON_SPREAD ** 2
    if freedom:
        common = sum((r.texts - 1) * (r.var or 0.0) for r in found) / freedom
        common = (freedom * common + COMMON_SPREAD ** 2) / (freedom + 1)
    for r in found:
        var = ((r.texts - 1) * (r.var or 0.0) + COMMON_TEXTS * common) / (r.texts - 1 + COMMON_TEXTS)
        mean[r.k] = r.mean
        spread[r.k] = math.sqrt(var * (1 + 1 / r.texts))  # the mean of few texts is uncertain too
        own[r.k] = math.sqrt(max(r.own, 0.0))
    cut = _cut(measured, [
        (r.k, r.texts, float(mean[r.k]), float(spread[r.k]), float(own[r.k])) for r in found if r.texts > 1
    ])
    return Model(model.languages, model.grams, model.backoff, model.floor, mean, spread, own, cut)


def _cut(measured: DataFrame, found: list[tuple]) -> float:
    """How many spreads above the mean all calibrating texts but ``REJECTED_SHARE`` have at most.

    Each text is held against the mean of the others of its language. Where there are too few for
    the quantile, the tail beyond the upper tenth is taken as exponential.
    """
    if not found:
        return REJECT_AT
    stats = measured.sparkSession.createDataFrame(
        found, "k int, texts bigint, mean double, spread double, own double"
    )
    above = F.expr("(cost - mean) * texts / (texts - 1) / sqrt(spread * spread + own * own / n)")
    z = measured.join(broadcast_if_small(stats, MAX_LANGUAGES), "k").select(above.alias("z"))
    r = z.where("z IS NOT NULL").agg(
        F.count("*").alias("n"),
        F.percentile_approx("z", [0.9, 1 - REJECTED_SHARE], 100_000).alias("q"),
    ).first()
    if r.n < LEAST:
        return REJECT_AT
    tenth, last = r.q
    if r.n * REJECTED_SHARE >= 1:
        return float(last)
    beyond = z.where(F.col("z") > tenth).agg(F.avg(F.col("z") - tenth)).first()[0] or 0.0
    return float(max(last, tenth + beyond * math.log(0.1 / REJECTED_SHARE)))


def classify(
    model: Model, texts: list[np.ndarray], reject_at: float | None = None
) -> list[tuple]:
    """Per text the language, score, cross-entropy per letter in nats, and whether it is rejected."""
    unread = (UNKNOWN, 0.0, None)
    out = [(*unread, len(codes) < 2) for codes in texts]
    read = [i for i, codes in enumerate(texts) if len(codes) > 1]
    if not model.languages or not read:
        return out
    reject_at = model.reject_at if reject_at is None else reject_at
    for i, costs in zip(read, model.costs_of([texts[i] for i in read])[0]):
        n = len(texts[i]) - 1
        best = int(np.argmin(costs))
        # The posterior of the winner, with the evidence of a text bounded.
        score = 1.0 / np.exp(np.clip((costs[best] - costs) / n * min(n, 100), -50, 0)).sum()
        entropy = costs[best] / n
        allowed = math.hypot(model.spread[best], model.own_spread[best] / math.sqrt(n))
        out[i] = (
            model.languages[best], float(score), float(entropy),
            bool(entropy > model.mean[best] + reject_at * allowed),
        )
    return out


def predict(
    model: Model, table: DataFrame, *, id_column: str = "doc_id", text: str = "text",
    reject_at: float | None = None,
) -> DataFrame:
    """``(doc_id, lang_pred, score, entropy, rejected)`` per row of ``table``.

    A null text, and one without a letter, is ``und`` with score 0, and rejected. A model without
    languages calls all else ``und`` too, and rejects none of it. A tie goes to
    the language that comes first by name. Ids may be null or repeated; other columns are not
    looked at.
    """
    rows = table.select(col(id_column).alias("doc_id"), col(text).cast("string").alias("text"))
    shared = model.sent(table.sparkSession)
    types = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
    names = ["doc_id", "lang_pred", "score", "entropy", "rejected"]

    def run(batches):
        letter, model = _letter_table(), Model.received(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out = []
            for a in range(0, len(texts), 256):
                out += classify(model, [letters(t, letter) for t in texts[a:a + 256]], reject_at)
            found = [pa.array([o[i] for o in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, entropy double, rejected boolean"
    )


def keep_recognised(
    model: Model, table: DataFrame, *, text: str = "text", reject_at: float | None = None
) -> DataFrame:
    """The rows and columns of ``table`` whose text is not rejected."""
    shared = model.sent(table.sparkSession)

    @F.pandas_udf("boolean")
    def recognised(texts: pd.Series) -> pd.Series:
        letter, model = _letter_table(), Model.received(shared.value)
        kept = []
        for a in range(0, len(texts), 256):
            some = [letters(t, letter) for t in texts.iloc[a:a + 256]]
            kept += [not found[3] for found in classify(model, some, reject_at)]
        return pd.Series(kept, dtype=bool)

    return table.where(recognised(col(text)))
