import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

import __spark_entry__ as entry
from eventpulse.operators.classifier import precision_recall
from eventpulse.operators.instances import _clean, classify_documents, classify_sentences, fit_sentences

SCHEMA = "doc_id bigint, text string, negative int"


def corpus(seed, n=240):
    """Documents of many clean sentences; a negative one has one or two bad ones."""
    rng = random.Random(seed)
    plain = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = []
    for i in range(n):
        sentences = [" ".join(rng.choices(plain, k=8)) for _ in range(rng.randint(4, 12))]
        bad = i % 4 == 0
        for _ in range(rng.randint(1, 2) if bad else 0):
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(["vile", "rotten", "foul"])
        rows.append((i, ". ".join(sentences) + ".", int(bad)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    return fit_sentences(spark.createDataFrame(corpus(1), SCHEMA), features=1 << 12)


def test_the_bad_sentences_are_found(spark, fitted):
    rows = spark.createDataFrame(corpus(2), SCHEMA)
    found = precision_recall(
        classify_documents(fitted, rows).join(rows.select("doc_id", "negative"), "doc_id")
    ).first()
    assert found.precision > 0.95 and found.recall > 0.95
    sentences = entry.ep.split_sentences(rows.select("doc_id", "text"))
    said = classify_sentences(fitted, sentences).where("sentiment = 1").select("sentence").collect()
    bad = [r.sentence for r in said if any(w in r.sentence for w in ("vile", "rotten", "foul"))]
    assert len(bad) >= 0.9 * len(said) > 0


def test_the_place_of_the_likeliest_sentence(spark, fitted):
    rows = spark.createDataFrame([(1, "worda wordb. so vile here. wordc", 1)], SCHEMA)
    assert classify_documents(fitted, rows).first().pos == 1


def test_documents_without_sentences(spark, fitted):
    rows = spark.createDataFrame([(1, None, 1), (2, "", 0), (3, "...", 0), (4, "x", 0)], SCHEMA)
    got = {r.doc_id: (r.sentiment, r.pos) for r in classify_documents(fitted, rows).collect()}
    assert got == {1: (2, None), 2: (2, None), 3: (2, None), 4: (2, 0)}


def test_one_label_only_is_refused(spark):
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", None)], SCHEMA)
    with pytest.raises(ValueError):
        fit_sentences(rows)


def test_held_out_documents_of_the_driver(spark):
    found = entry.model_document_recall(spark, "/root/testdata/sf0.1").first()
    assert found.true_positive + found.false_negative == 83
    assert found.precision > 0.8 and found.recall > 0.6


def test_clean_documents_are_neither_scored_again_nor_joined(spark, monkeypatch):
    plans, fit = [], LogisticRegression.fit

    def noted(self, rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return fit(self, rows)

    monkeypatch.setattr(LogisticRegression, "fit", noted)
    fit_sentences(spark.createDataFrame(corpus(3, 80), SCHEMA), features=1 << 10, max_rounds=2, tolerance=0.0)
    # One join, of the sentences of negative documents with what was found of these documents.
    assert [p.count("Join Inner") for p in plans] == [0, 1]


def test_clean_sentences_of_an_id_with_both_labels_or_none(spark):
    counted = spark.createDataFrame(
        [(1, 0.0, "a"), (2, 0.0, "b"), (2, 1.0, "c"), (None, 0.0, "d"), (None, 1.0, "e"), (3, 1.0, "f")],
        "_doc bigint, _label double, _features string",
    )
    bags = counted.select("_doc", "_label").distinct()
    joined = counted.join(bags.select("_doc"), "_doc").where("_label = 0")
    assert sorted(r._features for r in _clean(counted, bags).collect()) == ["a", "b", "b"]
    assert sorted(r._features for r in joined.collect()) == ["a", "b", "b"]
