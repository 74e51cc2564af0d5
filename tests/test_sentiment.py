import re

import pytest
from pyspark.sql import functions as F

from eventpulse.calendars import TOURNAMENT
from eventpulse.operators.classifier import classify, fit_negative, precision_recall
from eventpulse.operators.sentiment import (
    compile_lexicon, keep_windows_with_any, negatives, negatives_per_window, score_sentences,
    sentiment_label, sentiment_sql, split_sentences, windows_with_any,
)

TEXTS = [
    "One. Two!Three?\nFour", "...", "", " \t lead. \r\n tail \t", "no end", "a. b. \U0001f600. cc",
    "A\n \nB", "tab\tinside stays.\x00nul\x00", "!?start", "x" * 5000 + "." + "y" * 3, None,
]


def pieces(text, short_too):
    out = []
    for pos, piece in enumerate(re.split(r"[.!?\n]+", text)):
        piece = piece.strip("".join(map(chr, range(0x21))))
        units = len(piece.encode("utf-16-le")) // 2
        if units > (0 if short_too else 1):
            out.append((pos, piece))
    return out


@pytest.mark.parametrize("short_too", [False, True])
def test_sentences_by_hand(spark, short_too):
    posts = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = split_sentences(posts, short_too=short_too)
    assert got.columns == ["id", "pos", "sentence"]
    want = [(i, *p) for i, t in enumerate(TEXTS) if t is not None for p in pieces(t, short_too)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


SENTENCES = [
    "the idiot and the clown", "Idiot IDIOT idiot", "with the and", "nothing", "idiot-clown", "",
    "the the the the", "don't idiotic", "ÜBEL über", "idiot",
]
WEIGHTS = [("idiot", -2), ("clown", -2), ("the", 1), ("and", 1), ("with", 1), ("über", 3),
           ("über", 1), ("don't", -9), (None, 5), ("nothing", None)]


def score(sentence):
    total = {}
    for token, weight in WEIGHTS:
        if token and weight:
            total[token] = total.get(token, 0) + weight
    return sum(total.get(w, 0) for w in re.split(r"[^a-zü]+", sentence.lower()))


def test_class_limits(spark):
    frame = spark.createDataFrame([(s,) for s in (-9, -4, -3, -1, 0, 1, 3, 4)], "s bigint")
    got = frame.select(F.expr(sentiment_sql("s")).alias("c")).select("c", sentiment_label("c").alias("l"))
    assert [tuple(r) for r in got.collect()] == [
        (0, "very negative"), (0, "very negative"), (1, "negative"), (1, "negative"),
        (2, "neutral"), (3, "positive"), (3, "positive"), (4, "very positive"),
    ]


@pytest.mark.parametrize("limit", [10_000, 0], ids=["plan", "join"])
def test_scores_by_hand(spark, limit):
    rows = [(i, s) for i, s in enumerate(SENTENCES)] + [(100 + i, "the idiot") for i in range(30)]
    sentences = spark.createDataFrame(rows, "id int, sentence string")
    lexicon = spark.createDataFrame(WEIGHTS, "token string, weight int")
    got = score_sentences(sentences, lexicon, max_tokens=limit)
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "string", "bigint", "int"]
    assert {r.id: r.score for r in got.collect()} == {i: score(s) for i, s in rows}


def test_scoring_needs_no_shuffle(spark):
    sentences = spark.createDataFrame([("a",)], "sentence string")
    lexicon = spark.createDataFrame(WEIGHTS, "token string, weight int")
    plan = score_sentences(sentences, lexicon)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("aggregate(") == 1


def test_empty_lexicon_is_neutral(spark):
    sentences = spark.createDataFrame([("the idiot",)], "sentence string")
    lexicon = spark.createDataFrame([], "token string, weight int")
    assert compile_lexicon(lexicon).tokens == {}
    row = score_sentences(sentences, lexicon).first()
    assert (row.score, row.sentiment) == (0, 2)


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(
        [(0, "bad one", 0), (0, "fine", 2), (1, "fine", 3), (46, "b", 1), (46, "\U0001f620", 1)],
        "bucket int, sentence string, sentiment int",
    )


def test_short_sentences_count_but_are_not_written(scored):
    assert {r.bucket: r.n for r in negatives_per_window(scored).collect()} == {0: 1, 46: 2}
    assert sorted((r.name, r.sentence) for r in negatives(scored).collect()) == [
        ("POST_CUP", "\U0001f620"), ("TUR_ITA", "bad one")
    ]


def test_windows_with_any(scored):
    assert sorted(map(tuple, windows_with_any(scored).collect())) == [
        (0, "TUR_ITA", 2, 1), (46, "POST_CUP", 2, 2)
    ]
    for limit in (1000, 1, 0):
        kept = keep_windows_with_any(scored, TOURNAMENT, max_windows=limit)
        assert sorted(r.bucket for r in kept.collect()) == [0, 0, 46, 46]


def test_classifier_learns_a_rare_word(spark):
    rows = [(f"some plain words number {i}", 0) for i in range(60)]
    rows += [(f"you idiot number {i}", 1) for i in range(6)]
    labelled = spark.createDataFrame(rows, "text string, negative int")
    model = fit_negative(labelled, features=256)
    scored = classify(model, labelled, text="text")
    assert scored.columns == ["text", "negative", "probability", "sentiment"]
    row = precision_recall(scored).first()
    assert (row.true_positive, row.false_negative) == (6, 0) and row.precision > 0.8
    new = spark.createDataFrame(
        [("x", "an idiot"), ("y", "plain words")], "text string, sentence string"
    )
    assert {r.text: r.sentiment for r in classify(model, new).collect()} == {"x": 1, "y": 2}


def test_classifier_needs_both_labels(spark):
    with pytest.raises(ValueError):
        fit_negative(spark.createDataFrame([("a", 0)], "text string, negative int"))
