"""Sentiment by a fitted classifier: words to hashed TF-IDF to logistic regression."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from eventpulse.functions.text import NON_LETTERS

LABEL = "negative"


def fit_negative(
    labelled: DataFrame,
    *,
    text: str = "text",
    label: str = LABEL,
    features: int = 1 << 12,
    max_iter: int = 20,
    reg_param: float = 0.01,
) -> PipelineModel:
    """Fit on ``(text, label)`` with label 0/1, both classes weighing the same in total.

    The label is rare, so without the weights the model would call nothing
    negative. Fitting is distributed; the driver holds one coefficient per
    hashed feature, however many rows there are.
    """
    words = RegexTokenizer(
        inputCol="_input", outputCol="_words", pattern=NON_LETTERS, gaps=True, toLowercase=True
    )
    hashed = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features, binary=True)
    rows = labelled.select(F.col(text).alias("_input"), F.col(label).cast("double").alias("label"))
    # Kept for the fits below, which pass over it several times; lost parts are recomputed.
    counted = hashed.transform(words.transform(rows)).select("label", "_tf").persist()
    try:
        counts = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).first()
        if not counts.pos or counts.pos == counts.n:
            raise ValueError("both labels must occur in the training data")
        weight = F.when(F.col("label") == 1.0, counts.n / (2.0 * counts.pos)).otherwise(
            counts.n / (2.0 * (counts.n - counts.pos))
        )
        idf = IDF(inputCol="_tf", outputCol="_features").fit(counted)
        regression = LogisticRegression(
            featuresCol="_features", labelCol="label", weightCol="weight",
            probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
            maxIter=max_iter, regParam=reg_param,
        ).fit(idf.transform(counted.withColumn("weight", weight)))
    finally:
        counted.unpersist()
    return PipelineModel(stages=[words, hashed, idf, regression])


def classify(
    model: PipelineModel, table: DataFrame, *, text: str = "sentence", threshold: float = 0.5
) -> DataFrame:
    """Add ``probability`` of being negative and ``sentiment``: 1 negative, 2 neutral."""
    probability = F.get(vector_to_array("_probability"), F.lit(1))
    scored = model.transform(table.withColumn("_input", F.col(text)))
    scored = scored.withColumn("probability", probability)
    sentiment = F.when(F.col("probability") > threshold, F.lit(1)).otherwise(F.lit(2))
    return scored.select(*table.columns, "probability", sentiment.alias("sentiment"))


def precision_recall(scored: DataFrame, label: str = LABEL) -> DataFrame:
    """One row ``(true_positive, false_positive, false_negative, precision, recall)``."""
    said, true = F.col("sentiment") <= 1, F.col(label) == 1
    counts = scored.agg(
        F.count_if(said & true).alias("true_positive"),
        F.count_if(said & ~true).alias("false_positive"),
        F.count_if(~said & true).alias("false_negative"),
    )
    hit = F.col("true_positive")
    return counts.withColumns({
        "precision": F.try_divide(hit, hit + F.col("false_positive")),
        "recall": F.try_divide(hit, hit + F.col("false_negative")),
    })
