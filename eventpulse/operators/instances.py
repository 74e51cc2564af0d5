"""Sentences labelled through their documents: multiple-instance learning.

Labels belong to whole documents, but it is sentences that are to be classified. A negative document
needs one negative sentence, not all, and a clean one has none. So the label of a sentence is taken
as unknown: a document is negative unless all its sentences are clean, and expectation maximisation
finds the sentences that explain the labels. Each round gives every sentence of a negative document
the probability that it is one of those, given the model so far and the document's label, and then
fits the model anew, each such sentence counting as negative and as clean in that proportion.

Every round is a distributed fit and a sum per document; the driver holds coefficients only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from eventpulse.functions.text import NON_LETTERS
from eventpulse.operators.sentiment import split_sentences

# A word whose sentences speak for or against it by no more than so many gets no weight, so that the
# words of a single document cannot stand for its label.
MIN_EVIDENCE = 1.5
# The histogram of document scores from which the threshold is chosen.
SCORE_BINS = 1000
# A probability stays this far from 0 and 1, so that its logarithm is finite.
MARGIN = 1e-9


@dataclass(frozen=True)
class SentenceModel:
    """A classifier of sentences, and from which score on a document is called negative."""

    model: PipelineModel
    threshold: float
    rounds: int


def _probability(column: str = "_probability") -> Column:
    p = F.get(vector_to_array(column), F.lit(1))
    return F.least(F.greatest(p, F.lit(MARGIN)), F.lit(1 - MARGIN))


def _any_of(probability: str) -> Column:
    """The probability that a document has a negative sentence."""
    return 1 - F.exp(F.sum(F.log1p(-F.col(probability))))


def sentences_of(documents: DataFrame, document: str, text: str, *more: str) -> DataFrame:
    """``_doc``, the columns ``more``, ``pos`` and ``sentence`` of the documents."""
    rows = documents.select(
        F.col(f"`{document}`").alias("_doc"), F.col(f"`{text}`").alias("_text"),
        *[F.col(f"`{c}`") for c in more],
    )
    return split_sentences(rows, text="_text", short_too=True)


def fit_sentences(
    documents: DataFrame,
    *,
    document: str = "doc_id",
    text: str = "text",
    label: str = "negative",
    features: int = 1 << 16,
    max_rounds: int = 4,
    max_iter: int = 25,
    min_evidence: float = MIN_EVIDENCE,
    tolerance: float = 0.002,
) -> SentenceModel:
    """Fit a classifier of sentences on documents with a label 0/1.

    ``document`` must be distinct per row. Documents without a sentence and null labels are left
    out. The penalty of the fits is on absolute weights, so that few words have any: a word needs more
    than ``min_evidence`` sentences that speak for it. Rounds end when the average probability given to the labels changes by less than
    ``tolerance``. The threshold for whole documents is the one of the best F1 on them.
    """
    rows = sentences_of(documents.where(F.col(f"`{label}`").isNotNull()), document, text, label)
    words = RegexTokenizer(
        inputCol="_input", outputCol="_words", pattern=NON_LETTERS, gaps=True, toLowercase=True
    )
    hashed = HashingTF(inputCol="_words", outputCol="_features", numFeatures=features, binary=True)
    rows = rows.select(
        "_doc", F.col(f"`{label}`").cast("double").alias("_label"), F.col("sentence").alias("_input")
    )
    counted = hashed.transform(words.transform(rows)).select("_doc", "_label", "_features")
    # Every round passes over it several times; lost parts are made again.
    counted, bags = counted.persist(StorageLevel.DISK_ONLY), None
    try:
        seen = {r["_label"]: r["n"] for r in counted.groupBy("_label").agg(F.count("*").alias("n")).collect()}
        if set(seen) != {0.0, 1.0}:
            raise ValueError("both labels must occur in the training data")
        regression = LogisticRegression(
            featuresCol="_features", labelCol="_class", weightCol="_weight",
            probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
            maxIter=max_iter, regParam=min_evidence / sum(seen.values()), elasticNetParam=1.0,
            standardization=False,
        )
        # At first, every sentence of a negative document counts as negative: words that only such
        # documents have stand out at once, and the next rounds take the rest back.
        clean = counted.where("_label = 0")
        share = counted.where("_label = 1").withColumn("_share", F.lit(1.0))
        fitted, likely, rounds = None, None, 0
        while rounds < max_rounds:
            fitted, rounds = regression.fit(_both_classes(clean, share)), rounds + 1
            before, bags = bags, _scored(fitted, counted).groupBy("_doc", "_label").agg(
                _any_of("_p").alias("_any")
            ).persist(StorageLevel.DISK_ONLY)
            now = bags.agg(F.avg(
                F.when(F.col("_label") == 1, F.col("_any")).otherwise(1 - F.col("_any"))
            )).first()[0]
            if before is not None:
                before.unpersist()
            if likely is not None and abs(now - likely) < tolerance:
                break
            likely = now
            # Sentences of clean documents are clean in every round, and only the others are scored again.
            clean = _clean(counted, bags)
            share = _scored(fitted, counted.where("_label = 1")).join(
                bags.select("_doc", "_any"), "_doc"
            ).withColumn(
                "_share", F.least(F.col("_p") / F.greatest("_any", F.lit(MARGIN)), F.lit(1.0))
            )
        threshold = _best_threshold(bags)
    finally:
        counted.unpersist()
        if bags is not None:
            bags.unpersist()
    return SentenceModel(PipelineModel(stages=[words, hashed, fitted]), threshold, rounds)


def _clean(counted: DataFrame, bags: DataFrame) -> DataFrame:
    """Sentences of clean documents with an id; once more where a negative document has that id."""
    clean = counted.where("_label = 0 AND _doc IS NOT NULL")
    both = bags.groupBy("_doc").agg(F.count("*").alias("n")).where("n > 1 AND _doc IS NOT NULL")
    return clean if both.isEmpty() else clean.unionByName(clean.join(both.select("_doc"), "_doc"))


def _both_classes(clean: DataFrame, share: DataFrame) -> DataFrame:
    """Sentences of clean documents as clean, those of others as both in their proportion."""
    weights = F.array(
        F.struct(F.lit(1.0).alias("_class"), F.col("_share").alias("_weight")),
        F.struct(F.lit(0.0).alias("_class"), (1 - F.col("_share")).alias("_weight")),
    )
    both = share.select("_features", F.inline(weights))
    return clean.select(
        "_features", F.lit(0.0).alias("_class"), F.lit(1.0).alias("_weight")
    ).unionByName(both.where("_weight > 0"))


def _scored(fitted: LogisticRegressionModel, vectors: DataFrame) -> DataFrame:
    return fitted.transform(vectors).select(
        "_doc", "_label", "_features", _probability().alias("_p")
    )


def _best_threshold(bags: DataFrame) -> float:
    """The score from which documents are called negative with the best F1, of a histogram."""
    rows = bags.groupBy(F.floor(F.col("_any") * SCORE_BINS).alias("bin")).agg(
        F.sum("_label").alias("true"), F.count("*").alias("n")
    ).collect()
    total = sum(r["true"] for r in rows)
    best, threshold, hit, said = -1.0, 0.5, 0.0, 0
    for r in sorted(rows, key=lambda r: -r["bin"]):
        hit, said = hit + r["true"], said + r["n"]
        if (score := 2 * hit / (said + total)) > best:
            best, threshold = score, r["bin"] / SCORE_BINS
    return threshold


def classify_sentences(fitted: SentenceModel, table: DataFrame, *, text: str = "sentence") -> DataFrame:
    """Add ``probability`` of being negative and ``sentiment``: 1 negative, 2 neutral."""
    scored = fitted.model.transform(table.withColumn("_input", F.col(f"`{text}`")))
    scored = scored.withColumn("probability", _probability())
    sentiment = F.when(F.col("probability") > 0.5, F.lit(1)).otherwise(F.lit(2))
    return scored.select(*table.columns, "probability", sentiment.alias("sentiment"))


def classify_documents(
    fitted: SentenceModel, documents: DataFrame, *, document: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``document, probability, sentiment, pos`` per document: that of any of its sentences being
    negative, 1 or 2 by the fitted threshold, and the place of the likeliest sentence.

    A document without a sentence has probability 0, sentiment 2 and no place.
    """
    rows = classify_sentences(fitted, sentences_of(documents, document, text))
    found = rows.withColumn("_p", F.greatest("probability", F.lit(MARGIN))).groupBy("_doc").agg(
        _any_of("_p").alias("probability"), F.max_by("pos", F.struct("_p", -F.col("pos"))).alias("pos")
    )
    sentiment = F.when(F.col("probability") >= fitted.threshold, F.lit(1)).otherwise(F.lit(2))
    named = documents.select(F.col(f"`{document}`").alias("_doc")).join(found, "_doc", "left")
    return named.select(
        F.col("_doc").alias(document), F.coalesce("probability", F.lit(0.0)).alias("probability"),
        F.when(F.col("probability").isNull(), F.lit(2)).otherwise(sentiment).alias("sentiment"), "pos",
    )
