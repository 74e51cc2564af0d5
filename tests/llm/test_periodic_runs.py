import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from eventpulse.llm import periodic_runs as pr, queries


def brute_runs(words, min_words=6, min_periods=4):
    n, out = len(words), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - i + q
            if length >= max(min_words, min_periods * q):
                part = words[i:i + length]
                if not any(all(part[j] == part[j + p] for j in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for trial in range(400):
        words = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            base = [rng.randrange(3) for _ in range(rng.randint(1, 11))]
            times = rng.randint(2, 7)
            part = (base * times)[:len(base) * times - rng.randrange(len(base))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        assert pr.find_runs(np.array(words, np.int64)) == brute_runs(words), words


def test_long_runs_of_every_period_are_found():
    rng = random.Random(2)
    for period in (1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 100):
        base = list(range(period))
        rng.shuffle(base)
        tail = rng.randrange(period)
        words = [900, 901] + base * 4 + base[:tail] + [902]
        want = [(2, 4 * period + tail, period)] if 4 * period + tail >= 6 else []
        assert pr.find_runs(np.array(words, np.int64)) == want
        short = [900] + (base * 4)[:-1] + [901]
        assert pr.find_runs(np.array(short, np.int64)) == []


def planted(doc_id, words):
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    runs = brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def answer(spark, tmp_path, rows):
    table = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "1 AS n_words", "'x' AS runs", "2 AS collapsed", "3 AS h", "4 AS words"
    )
    table.write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.op11_periodic_runs(spark, str(tmp_path))
    return sorted(
        map(tuple, out.select(
            "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
            "collapsed_sha256",
        ).collect()), key=str,
    )


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [
        (i, " ".join(rng.choice(["a", "b", "ü", "d e", "x\x1cy"]) for _ in range(rng.randrange(50))))
        for i in range(120)
    ]
    rows += [
        (500, None), (501, ""), (502, " \t\n\x0b\f\r "), (503, "one"), (None, "a a a a a a"), (None, None),
        (7, "la la la la la la"), (7, "la la la la la la"), (504, "x " * 5), (505, "x " * 6),
        (506, "  a\tb\na b a\rb a b c "), (507, "a b a c " * 9), (508, "😀 😀 😀 😀 😀 😀 😀"),
    ]
    assert answer(spark, tmp_path, rows) == sorted((expected(*r) for r in rows), key=str)


def test_empty_table(spark, tmp_path):
    assert answer(spark, tmp_path, []) == []


def test_copies_in_a_batch_are_texts_of_their_own(spark):
    rows = [(i, "a b c d " * 3) for i in range(20)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert {len(r.runs) for r in pr.periodic_runs(table).collect()} == {0}


@pytest.mark.parametrize("text", ["a " * 400_000, "a b c a b d " * 60_000])
def test_very_long_texts(spark, text):
    table = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = pr.periodic_runs(table).collect()[0]
    n, q = len(text.split()), len(set(text.split())) and (1 if "b" not in text else 6)
    assert [tuple(r) for r in row.runs] == [(0, n, q)]
    assert row.collapsed == " ".join(text.split()[:q])


def test_driver_table_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 6000").collect()
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, sf_dir).collect()}
    assert any(r.n_runs for r in got.values())
    for d in docs:
        r = got[d.doc_id]
        assert (
            r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256,
            r.collapsed_sha256,
        ) == expected(d.doc_id, d.text)
