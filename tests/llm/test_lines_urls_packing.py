import itertools
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from eventpulse.llm import line_dedup as ld, packing as pk, queries, url_filter as uf


def brute_lines(docs, min_words):
    """Texts left when every line of a run that occurred before is deleted; ids are in order."""
    seen, cut = {}, defaultdict(set)
    for i, text in enumerate(docs):
        lines = (text or "").split("\n") if text is not None else []
        for a, b in itertools.combinations(range(len(lines) + 1), 2):
            if sum(len(x.split()) for x in lines[a:b]) >= min_words:
                first = seen.setdefault(tuple(lines[a:b]), (i, a))
                if first != (i, a):
                    cut[i] |= set(range(a, b))
    return [
        None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut[i])
        for i, t in enumerate(docs)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_runs_deleted_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    lines = ["a b c", "d", "", "e f", "g h i j", "k", "l m"]
    docs = ["\n".join(rng.choices(lines, k=rng.randint(0, 9))) for _ in range(14)]
    docs += ["\n".join(lines * 3), "\n".join(lines * 3), None, "", "\n" * 40, "a b c\nd\n" * 9]
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "1 AS row_no", "2 AS pos"
    )
    out = ld.delete_repeated_runs(rows.repartition(3), min_words=5)
    assert out.columns == [*rows.columns, "deleted_runs"]
    got = {r.doc_id: r.text for r in out.collect()}
    assert [got[i] for i in range(len(docs))] == brute_lines(docs, 5)
    assert ld.delete_repeated_runs(rows.limit(0)).count() == 0


def test_lines_of_null_and_repeated_ids(spark):
    line = "one two three four five"
    rows = spark.createDataFrame([(None, line), (5, line), (5, line)], "doc_id bigint, text string")
    out = [(r.doc_id, r.text) for r in ld.delete_repeated_runs(rows, min_words=3).collect()]
    assert sorted(map(str, out)) == sorted(map(str, [(None, ""), (5, ""), (5, line)]))


RULES = queries.URL_RULES


def test_lines_are_cut_once_before_they_are_sorted(spark, monkeypatch):
    plans, saved = {}, ld.saved

    def noted(table, purpose):
        plans[purpose] = table._jdf.queryExecution().optimizedPlan().toString()
        return saved(table, purpose)

    monkeypatch.setattr(ld, "saved", noted)
    docs = spark.createDataFrame([(0, 2, "a b\n c"), (1, 1, ""), (2, 3, None)], "row_no bigint, id bigint, text string")
    got = ld.line_table(docs).orderBy("pos").collect()
    assert [(r.row_no, r.line_no, r.words) for r in got] == [(1, 0, 0), (0, 0, 2), (0, 1, 1)]
    # A sort takes a sample of its input first, which must not mean to hash all texts twice.
    assert "sha2" in plans["cut"] and "Sort" in plans["lines"] and "sha2" not in plans["lines"]


def brute_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(itertools.takewhile(lambda c: c not in "/?#", rest))
    path = "".join(itertools.takewhile(lambda c: c not in "?#", rest[len(host):]))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        r for r in RULES
        if (host == (h := r.pattern.split("/")[0]) or host.endswith("." + h))
        and path.startswith(r.pattern[len(h):])
    ]
    best = max(fits, key=lambda r: len(r.pattern), default=None)
    return host, path, best.pattern if best else None, best.verdict if best else None


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.COM/en/1?x", "https://www.example.com/en/2#t", "x://net/es/",
    "http://a.net/fr/é", "http://example.com", "http://com/", "http://examplecom/", "a://b://c/d", "http://h?q/en/",
    "http://z.org/" + "a/" * 300, "HTTP://ÉX.com/1\n2", "http://sub.www.example.com/en/", "http://www.example.com/EN/",
]


def test_rules_equal_brute_force(spark):
    rows = spark.createDataFrame([*enumerate(URLS), (3, URLS[3]), (None, "http://a.com/")], "page_id bigint, url string")
    out = uf.judge_urls(rows.selectExpr("*", "1 AS host", "2 AS segs"), RULES).collect()
    assert len(out) == len(URLS) + 2
    for r in out:
        if r.page_id is not None:
            host, path, rule, verdict = brute_rule(URLS[r.page_id])
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert r.verdict == verdict or verdict is None and r.verdict in ("allow", "block")
    assert uf.judge_urls(rows.limit(0), RULES).count() == 0


def test_templates_generalise_merge_and_reject(spark):
    urls = [f"http://h.org/u{chr(97 + i % 26)}{chr(97 + i // 26)}/spam/{i}" for i in range(300)]
    urls += [f"http://h.org/u{chr(97 + i % 26)}{chr(97 + i // 26)}/page/{i}" for i in range(300)]
    urls += [f"http://h.org/fix/{i}.html" for i in range(200)]
    rules = [uf.Rule(f"h.org/u{chr(97 + i)}", "block" if i < 13 else "allow") for i in range(0)]
    rules += [uf.Rule(f"h.org/u{a}{b}/spam/", "block") for a in "abcdefgh" for b in "abcdefgh"]
    rules += [uf.Rule(f"h.org/u{a}{b}/page/", "allow") for a in "abcdefgh" for b in "abcdefgh"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    out = uf.judge_urls(rows, rules).collect()
    assert all(r.verdict == "block" for r in out if "/spam/" in r.path)
    assert all(r.verdict == "allow" for r in out if "/spam/" not in r.path)
    assert any(r.rule is None and r.verdict == "block" for r in out)
    assert {r.template for r in out if "/spam/" in r.path} == {"/*/spam/{n}"}
    assert {r.template for r in out if "/fix/" in r.path} == {"/fix/{n}.html"}


FILE = queries.tokenizer_file()
TEXTS = [
    "", None, "Hello World's don't I'LL 123 !!! 'sfoo .\"'s", "É ç ß ñ º ² ¼ ¡hola! «x» naïve\u00a0y", "tab\tnew\nline\x0b\x1c.",
    "日本語 \U0001F600 e\u0301 İ Σ", "<|endoftext|> x", "word " * 9000, "a" * 5000, "x\x85y\u2028z", "ŉ Ĳ ĳ ſ Ŀ",
]


def test_ids_are_the_tokenizers(spark):
    tokenizer = Tokenizer.from_file(FILE)
    words, patterns = pk.WordIds(tokenizer, 50), pk.word_pattern()
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choices(pk._KNOWN + ["'", " ", "s", "t"], k=60)) for _ in range(300)]
    got = pk.id_bytes(texts, tokenizer, words, patterns)
    for text, ids in zip(texts, got):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(ids, "<u4").tolist() == want, text


def test_packing_round_trip_and_layout(spark):
    rows = [*enumerate(TEXTS), (2, TEXTS[2]), (None, "null id")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS piece", "2 AS free")
    out = pk.pack_documents(table, FILE, capacity=256).toPandas()
    tokenizer = Tokenizer.from_file(FILE)
    want = sorted(
        (str(i), np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
        for i, t in rows
    )
    pieces = defaultdict(list)
    for r in sorted(out.itertuples(), key=lambda r: r.piece):
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        key = "None" if np.isnan(r.doc_id) else str(int(r.doc_id))
        pieces[key].append((r.start, r.ids))
    for doc_id, ids in want:
        assert b"".join(p for _, p in pieces[doc_id]) == ids or doc_id == "2"
    assert_layout(out, 256)
    assert pk.pack_documents(table.limit(0), FILE).count() == 0


def assert_layout(out, capacity):
    for _, own in out.groupby("sequence_id"):
        at = 0
        for r in own.sort_values("offset").itertuples():
            assert r.offset == at
            at += r.length
        assert at <= capacity


def test_few_sequences_over_many_shards(spark):
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 100, 3000)
    pieces = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "piece_no bigint, length bigint")
    out = pk.pack_pieces(pieces, capacity=100, shard_pieces=400).join(pieces, "piece_no").toPandas()
    assert sorted(out.piece_no) == list(range(3000))
    assert_layout(out, 100)
    assert out.sequence_id.nunique() <= 1.02 * math.ceil(lengths.sum() / 100)
    even = spark.range(900).selectExpr("id AS piece_no", "51L AS length")  # no two of these share a bin
    assert pk.pack_pieces(even, capacity=100, shard_pieces=100).select("sequence_id").distinct().count() == 900


def test_crossover_keeps_every_piece_once():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 60, 200)
    one, two = (pk.packed(lengths, rng.permutation(200), 100) for _ in range(2))
    for child in (pk.crossover(one, two, lengths, 100, rng), pk.mutate(one, lengths, 100, rng)):
        assert child.min() == 0 and np.bincount(child, lengths).max() <= 100
        assert len(np.unique(child)) == child.max() + 1
    best = pk.evolve(lengths, [one, two], 100, [1], generations=8)
    assert pk.fitness(best, lengths, 100) >= max(pk.fitness(x, lengths, 100) for x in (one, two))
