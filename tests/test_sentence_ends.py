import math
import re
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from eventpulse.operators.sentence_ends import (
    abbreviations, ends_pattern, split_by_statistics, stop_counts,
)
from eventpulse.operators.sentiment import split_sentences

TEXTS = [
    "Dr. Meyer paid 3.5 euros. He left. The house is old.",
    "We met Dr. Braun and Dr. Kuhn, e.g. at noon. Then we left the house. It rained!",
    "DR. WHO? Version 2.0.1 of the house. Dr. No. house number 5.",
    "Ask Dr. Ey. The house. Nothing...more\nA new line. dr. small", None, "", " . ", "é. ü. Drdr. x",
    "Das ist ca. zwei Meter. Er kam ca. um neun. Es ist ca. acht. Also ca. vier. So ca. drei.",
]


@pytest.fixture
def posts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id int, text string")


def brute_counts():
    found = Counter(), Counter()
    for t in TEXTS:
        for m in regex.finditer(r"\p{L}+", t or ""):
            found[0][m[0].lower()] += 1
            found[1][m[0].lower()] += t[m.end():m.end() + 1] == "."
    return found


def brute_split(text, words):
    """Character by character."""
    pieces, piece, i = [], "", 0
    while i < len(text):
        c, ends = text[i], text[i] in "!?\n"
        if c == ".":
            before = regex.search(r"\p{L}+$", text[:i])
            between = re.match(r"[0-9]\.[0-9]", text[max(i - 1, 0):i + 2]) is not None and i > 0
            ends = not between and not (before and before[0].lower() in words)
        if ends:
            pieces.append(piece)
            piece = ""
        else:
            piece += c
        i += 1
    trimmed = [p.strip("".join(map(chr, range(33)))) for p in [*pieces, piece]]
    return [p for p in trimmed if len(p) > 1]


def test_counts_by_brute_force(posts):
    n, stops = brute_counts()
    assert {r.word: (r.n, r.n_stop) for r in stop_counts(posts).collect()} == {
        w: (n[w], stops[w]) for w in n
    }


def test_scores_by_the_formula(posts):
    n, stops = brute_counts()
    p, want = sum(stops.values()) / sum(n.values()), {}
    for w in n:
        if stops[w] >= 2:
            def log(q, w=w):
                return stops[w] * math.log(q) + (n[w] - stops[w]) * math.log(1 - q)
            score = 2 * (log(0.99) - log(p)) * math.exp(-len(w)) / max(len(w), 2) ** (n[w] - stops[w])
            if score >= 0.3:
                want[w] = score
    got = {r.word: r.score for r in abbreviations(stop_counts(posts), min_count=2).collect()}
    assert got == pytest.approx(want) and {"dr", "ca"} <= set(got) and "house" not in got


@pytest.mark.parametrize("limit", [200, 0], ids=["pattern", "join"])
def test_sentences_by_brute_force(spark, posts, limit):
    words = ["dr", "ca", "g", "é"]
    listed = spark.createDataFrame([(w,) for w in words], "word string")
    got = {}
    for r in split_by_statistics(posts, listed, max_words=limit).collect():
        got.setdefault(r.id, []).append((r.pos, r.sentence))
    assert {i: [s for _, s in sorted(x)] for i, x in got.items()} == {
        i: s for i, t in enumerate(TEXTS) if (s := brute_split(t or "", words))
    }


def test_without_abbreviations_only_stops_between_digits_differ(spark, posts):
    none = spark.createDataFrame([], "word string")
    plain = posts.where("text NOT RLIKE '[0-9][.][0-9]'")
    for limit in (200, 0):
        got = split_by_statistics(plain, none, max_words=limit).select("id", "sentence").collect()
        assert sorted(map(tuple, got)) == sorted(
            map(tuple, split_sentences(plain).select("id", "sentence").collect())
        )


def test_no_posts(spark, posts):
    counts = stop_counts(posts.limit(0))
    assert counts.count() == 0 and abbreviations(counts).count() == 0
    assert ends_pattern([]).startswith("(?:\\.")


def test_abbreviations_are_looked_for_behind_stops_only(spark):
    """In front of the stop, the whole list was tried at every character of a text."""
    pattern = ends_pattern(["dr", "etc"])
    assert pattern.index(r"\.") < pattern.index("(?<!")
    text = "Dr. No, etc. 3.5 xdr. A.b? "
    row = spark.createDataFrame([(text,)], "t string").select(F.split("t", pattern, -1).alias("p")).first()
    assert row.p == ["Dr. No, etc. 3.5 xdr", " A", "b", " "]
