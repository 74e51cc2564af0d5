import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from eventpulse.llm import queries, spelling_variants as sv


def edited(a, b):
    """Whether exactly one inserted, deleted or replaced code point leads from one to the other."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(counts, ratio=5):
    near = {w: [v for v in counts if edited(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-counts[v], [ord(c) for c in v]))
            if counts[best] >= ratio * counts[w]:
                form[w] = best
    def root(w):
        while w in form:
            w = form[w]
        return w
    return {
        w: (form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None)
        for w, n in counts.items()
    }


def groups(spark, counts, **more):
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint").selectExpr(
        "*", "'x' AS form", "1 AS block", "2 AS chunk", "3 AS near"
    )
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n)
            for r in sv.group_variants(table, **more).collect()}


def vocabulary(seed, n=400):
    rng = random.Random(seed)
    letters = "abcdeéÀzß"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(6, 12))) for _ in range(40)}
    while len(words) < n:
        w = list(rng.choice(sorted(words)))
        at, kind = rng.randrange(len(w)), rng.randrange(4)
        if kind == 0 and len(w) > 6:
            del w[at]
        elif kind == 1:
            w.insert(at, rng.choice(letters))
        elif kind == 2:
            w[at] = rng.choice(letters)
        else:
            rng.shuffle(w)  # the same letters in another order are no variant
        words.add("".join(w))
    return {w: rng.choice([5, 5, 6, 25, 30, 126, 700, 4000]) for w in sorted(words)}


@pytest.mark.parametrize("classes,folds,chunk", [(5, 64, 1024), (1, 64, 1024), (3, 4, 7)])
def test_groups_equal_brute_force(spark, monkeypatch, classes, folds, chunk):
    monkeypatch.setattr(sv, "CHUNK_WORDS", chunk)
    counts = vocabulary(4)
    want = brute_groups(counts)
    assert any(x[0] and x[0] != x[1] for x in want.values())  # chains of forms
    assert groups(spark, counts, classes=classes, folds=folds) == want


def test_other_alphabets_and_long_words(spark):
    long = "ab" * 3000
    counts = {long: 10, long + "c": 100, "x" + long: 3, "日本語日本語": 5, "日本語日本誤": 50,
              "😀😀😀😀😀😀": 7, "😀😀😀😀😀": 60, "aaaaaa": 1}
    assert groups(spark, counts) == brute_groups(counts)


def test_empty_and_null(spark):
    assert groups(spark, {}) == {}
    table = spark.createDataFrame([(None, 7), ("abcdef", 5)], "word string, n bigint")
    assert [r.word for r in sv.group_variants(table).collect()] == ["abcdef"]


def test_one_edit():
    rng = random.Random(5)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(6))
        b = "".join(rng.choice("ab") for _ in range(rng.choice([6, 7])))
        got = sv.one_edit(sv.letter_codes(a, 6), sv.letter_codes(b, len(b)))
        assert bool(got[0]) == edited(a, b), (a, b)


def brute_counts(rows):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def check_query(spark, sf_dir, rows):
    got = {r.word: tuple(r)[1:] for r in queries.op12_spelling_variants(spark, sf_dir)
           .select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute_groups(brute_counts(rows))
    return got


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(6)
    words = ["Straße", "straßen", "ÉCOLE éç×÷", "letters", "Lettars", "letter", "tiny", "variants"]
    rows = [(i, " ".join(rng.choices(words, k=30)) + "1") for i in range(300)]
    rows += [(None, "letters " * 50), (None, None), (900, None), (901, ""), (902, "abcdefgh" * 4000),
             (903, "lettersÀ " * 9), (7, rows[7][1]), (904, "pattern-patterns_patterns 0patterns patterns,patterns")]
    spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "1 AS run", "'x' AS word", "2 AS n"
    ).write.parquet(str(tmp_path / "documents.parquet"))
    got = check_query(spark, str(tmp_path), rows)
    assert any(v[0] for v in got.values())


def test_driver_table_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert check_query(spark, sf_dir, rows)


def test_counts_are_exact_in_long_words():
    codes = np.full((2, 5000), ord("a"), np.uint32)
    assert sv.letter_counts(codes)[0].max() == 5000 and sv.letter_counts(codes).dtype == np.float64
