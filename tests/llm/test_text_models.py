import collections
import itertools
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from eventpulse.llm import gumbel_pieces as g, language_id as lid, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return model, g.Pieces.of(model)


def keys(n):
    return np.array([g.row_key(i) for i in range(n)], np.uint64)


def segmentations(text, model, pieces):
    if not text:
        return [((), 0.0)]
    found = []
    for n in range(1, len(text) + 1):
        i = model.piece_to_id(text[:n])
        if model.id_to_piece(i) == text[:n]:
            found += [((i, *r), pieces.weights[i] + w) for r, w in segmentations(text[n:], model, pieces)]
    return found


def test_samples_have_the_law_of_sampling_without_replacement(pieces):
    model, p = pieces
    every = segmentations(g.SPACE + "the", model, p)
    weights = np.exp([w for _, w in every])
    probability = weights / weights.sum()
    n = 20_000
    out = g.sampled(["the"] * n, keys(n), model, p, 3)
    place = {ids: i for i, (ids, _) in enumerate(every)}
    drawn = [[place[tuple(np.frombuffer(s[0], "<u4").tolist())] for s in own] for own in out]
    assert all(len(set(d)) == len(d) == min(3, len(every)) for d in drawn)
    second = sum(
        np.where(np.arange(len(every)) == a, 0, q * probability / (1 - q)) for a, q in enumerate(probability)
    )
    for nth, law in ((0, probability), (1, second)):
        seen = collections.Counter(d[nth] for d in drawn)
        for i, q in enumerate(law):
            assert abs(seen[i] / n - q) < 5 * math.sqrt(q * (1 - q) / n) + 1e-3
    for own, d in zip(out[:200], drawn):
        assert [s[1] for s in own] == pytest.approx(np.log(probability[d]), abs=1e-9)
        assert [s[2] for s in own] == sorted((s[2] for s in own), reverse=True)


TEXTS = ["", None, "a", "  two  blanks ", "tab\tline\n日本語 \U0001F600 é", "x" * 3000, "word " * 2000, "▁"]


def test_round_trip_samples_are_seeded_by_the_row_and_distinct(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "null id")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS sample", "2 AS ids")
    sampled = g.sample_segmentations(table, MODEL, k=4)
    out = g.decode(sampled, MODEL).collect()
    again = g.sample_segmentations(table.repartition(3), MODEL, k=4).collect()
    assert sorted(map(str, sampled.collect())) == sorted(map(str, again))
    texts = dict(rows)
    for doc_id in texts:
        own = [r for r in out if r.doc_id == doc_id]
        assert {r.decoded for r in own} == {(texts[doc_id] or "").replace("▁", " ")} - {None}
        assert len({bytes(r.ids) for r in own}) == max(r.sample for r in own)
    assert [r.log_inclusion for r in out if r.doc_id == 0] == [0.0]  # only one way to cut an empty text
    assert g.sample_segmentations(table.limit(0), MODEL).count() == 0


def kneser_ney(counts, vocabulary_of):
    """Interpolated Kneser-Ney written with dictionaries: probability of a letter after three."""
    raw = {4: collections.Counter(counts)}
    for n in (3, 2, 1):
        raw[n] = collections.Counter(k[1:] for k in raw[n + 1])
    discount = {}
    for n in raw:
        ones, twos = (sum(v == k for v in raw[n].values()) for k in (1, 2))
        discount[n] = min(0.95, ones / (ones + 2 * twos)) if ones else 0.5

    def p(gram, n):
        if n == 1:
            total = sum(raw[1].values())
            return max(raw[1][gram] - discount[1], 0) / total + discount[1] * len(raw[1]) / total / lid.ALPHABET
        followers = [v for k, v in raw[n].items() if k[:-1] == gram[:-1]]
        if not followers:
            return p(gram[1:], n - 1)
        total, d = sum(followers), discount[n]
        return max(raw[n][gram] - d, 0) / total + d * len(followers) / total * p(gram[1:], n - 1)

    return p


def test_costs_are_those_of_interpolated_kneser_ney():
    letter = lid._letter_table()
    rng = random.Random(3)
    texts = {"x": "".join(rng.choices("abcd ", k=400)), "y": "".join(rng.choices("bcde ", [5, 1, 1, 2, 2], k=300))}
    counted, laws = [], {}
    for lang, text in texts.items():
        codes = lid.letters(text, letter)
        grams, n = np.unique(lid.grams4(codes), return_counts=True)
        counted.append((lang, grams, n))
        padded = "  " + "".join(map(chr, codes.astype(int)))
        laws[lang] = kneser_ney([padded[i:i + 4] for i in range(len(padded) - 3)], None)
    model = lid.build(counted)
    for text in ("abcd bcde", "zz q", "éa", "b"):
        codes = lid.letters(text, letter)
        padded = "  " + "".join(map(chr, codes.astype(int)))
        want = [
            -sum(math.log(laws[lang](padded[i:i + 4], 4)) for i in range(len(padded) - 3)) for lang in ("x", "y")
        ]
        assert model.costs(codes)[0] == pytest.approx(want, rel=1e-9)


def test_language_of_driver_documents_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    out = queries.op2_language_id(spark, sf_dir).join(labels, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(out) == labels.count() and len(held) > 100
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert sum(r.rejected for r in out) <= 0.01 * len(out)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_without_letters_labels_or_rows(spark):
    english, german = "the cat and the dog were there " * 8, "der hund und die katze waren dort " * 8
    rows = [(i, (english, german)[i % 2], ("en", "de")[i % 2]) for i in range(80)]
    odd = [(100, None, "en"), (101, "", "en"), (102, "123 !!", "de"), (None, english, None), (103, "日本", None)]
    odd += [(104, "qzx jvw kqq " * 60, None), (1, german, "de")]
    table = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string").selectExpr("*", "1 AS score")
    model = lid.fit(table)
    out = lid.predict(model, table).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows) + len(odd) and model.languages == ("de", "en")
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected for i in (100, 101, 102))
    assert by[None].lang_pred == "en" and by[1].lang_pred == "de" and not by[1].rejected
    assert by[104].rejected and by[103].lang_pred in ("de", "en")
    kept = lid.keep_recognised(model, table)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if not r.rejected}
    none = lid.fit(table.limit(0))
    assert none.languages == () and lid.predict(none, table).where("rejected").count() == 3
    assert lid.predict(model, table.limit(0)).count() == 0


def test_sample_bound_keeps_at_most_so_many_rows(spark):
    rows = spark.range(5000).selectExpr("id", "cast(id AS string) AS text", "if(id < 4900, 'a', 'b') AS lang")
    sizes = {r.lang: r["count"] for r in lid._sampled(rows, 1000).groupBy("lang").count().collect()}
    assert 900 <= sizes["a"] <= 1000 and sizes["b"] == 100


def test_no_language_loses_rare_grams_to_others(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "".join(map(chr, rng.integers(0x4E00, 0x9FA5, 4000))), "aa") for i in range(700)]
    rows += [(1000 + i, "".join(map(chr, rng.integers(0x430, 0x450, 200))), "zz") for i in range(12)]
    rows += [(2000 + i, "один и тот же текст " * 9, "yy") for i in range(5)]  # all in one fold
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    model = lid.fit(table)
    assert model.languages == ("aa", "yy", "zz")
    letter, seen = lid._letter_table(), {"aa": set(), "zz": set()}
    for i, text, lang in rows:
        if lang == "zz":
            seen[lang].update(lid.grams4(lid.letters(text, letter)).tolist())
    entries = np.bincount(model.grams[4].languages, minlength=3)
    assert entries[0] > lid.GRAMS_AT_ONCE and entries[2] > 0.5 * len(seen["zz"])
    asked = table.where("lang <> 'aa'")
    assert {(r.lang, r.lang_pred) for r in asked.join(lid.predict(model, asked), "doc_id").collect()} == {
        ("yy", "yy"), ("zz", "zz")
    }


def test_a_language_of_many_rows_in_its_first_cell_stays(spark):
    rows = spark.range(50).selectExpr("1L AS id", "'same' AS text", "'a' AS lang").union(
        spark.range(300_000).selectExpr("id", "'other' AS text", "'b' AS lang")
    )
    sizes = {r.lang: r["count"] for r in lid._sampled(rows, 20).groupBy("lang").count().collect()}
    assert sizes["a"] == 50 and 0 < sizes["b"] <= 20


def words_of(rng, letters, n):
    return ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n)]


def test_rejection_spares_rare_languages_and_finds_unlearnt_ones(spark):
    rng = random.Random(5)
    common = {lang: words_of(rng, own, 300) for lang, own in (
        ("aa", "aeioustnrl"), ("bb", "aouchgmwkz"), ("rare", "eiybdfpvjq"),
    )}
    unlearnt = words_of(rng, "aeiousmwcg", 300)  # letters that were seen, in other words

    def text(own, n):
        topic = rng.sample(own, 120)  # texts differ in what they are about
        return " ".join(rng.choices(topic, k=n))

    rows = [(i, text(common[lang], 60), lang) for i, lang in enumerate(["aa", "bb"] * 200)]
    rare = [text(common["rare"], 400) for _ in range(8)]
    rows += [(1000 + i, t, "rare") for i, t in enumerate(rare)]
    copied = next(t for t in (text(common["rare"], 400) for _ in range(1000)) if _calibrates(spark, t))
    rows += [(1100 + i, copied, "rare") for i in range(20)]
    asked = [(2000 + i, text(common["rare"], 4000), None) for i in range(20)]
    asked += [(3000 + i, text(common["aa"], n), None) for i, n in enumerate([8, 20, 60, 4000] * 5)]
    asked += [(4000 + i, text(unlearnt, n), None) for i, n in enumerate([20, 60, 4000] * 7)]
    table = spark.createDataFrame(rows + asked, "doc_id bigint, text string, lang string")
    model = lid.fit(table)
    rejected = {r.doc_id for r in lid.predict(model, table).where("rejected").collect()}
    assert not {i for i in rejected if 1000 <= i < 4000}
    assert len({i for i in rejected if i < 1000}) <= 4
    assert {i for i, _, _ in asked if i >= 4000} <= rejected
    assert lid.REJECT_AT != model.reject_at


def _calibrates(spark, text):
    return spark.range(1).selectExpr(f"pmod(xxhash64('{text}'), {lid.CALIBRATION}) = 0 AS c").first().c


def test_second_sample_of_several_words_has_its_law(pieces):
    model, p = pieces
    every = [((), 0.0)]
    for word in ("of", "an", "it"):
        own = segmentations(g.SPACE + word, model, p)
        every = [(a + b, v + w) for a, v in every for b, w in own]
    probability = np.exp([w for _, w in every])
    probability /= probability.sum()
    place, n = {ids: i for i, (ids, _) in enumerate(every)}, 20_000
    out = g.sampled(["of an it"] * n, keys(n), model, p, 2)
    drawn = np.array([[place[tuple(np.frombuffer(s[0], "<u4").tolist())] for s in own] for own in out])
    law = sum(
        np.where(np.arange(len(every)) == a, 0, q * probability / (1 - q)) for a, q in enumerate(probability)
    )
    for nth, law in ((0, probability), (1, law)):
        expected, seen = n * law, np.bincount(drawn[:, nth], minlength=len(every))
        chi = (np.square(seen - expected) / expected)[expected >= 5]
        assert chi.sum() < len(chi) + 6 * math.sqrt(2 * len(chi))


def test_the_query_decodes_every_document(spark):
    out = queries.op1_gumbel_pieces(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and out.where("decoded_crc32 IS DISTINCT FROM text_crc32").count() == 0


@pytest.mark.parametrize("text", ["\ufffd\U0001f600", "\U0001f600", "\ufffd", "1 2 \ufffd \U0001f600!"])
def test_a_text_without_a_letter_has_no_codes(text):
    assert len(lid.letters(text, lid._letter_table())) == 0


def test_words_keep_the_blanks_in_front_of_them():
    word = re.compile(f"{g.SPACE}*[^{g.SPACE}]+|{g.SPACE}+")
    rng = random.Random(5)
    for _ in range(300):
        normal = ["".join(rng.choices("ab\0" + 3 * g.SPACE, k=rng.randint(0, 7))) for _ in range(rng.randint(0, 4))]
        index, words, text = g.words_in(normal)
        own = [word.findall(t) for t in normal]
        assert [index[w] for w in words] == [w for o in own for w in o]
        assert text.tolist() == [t for t, o in enumerate(own) for _ in o]
        assert len(index) == len(set(index))


def test_edges_have_their_places_without_a_sort(pieces, monkeypatch):
    sorts, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, **how: sorts.append(len(a)) or argsort(a, **how))
    lattice = g.Lattice(["▁the", "ab", "▁" * 3, "é\ud7ffa"], pieces[1])
    assert len(sorts) == 1  # by what is left of the word
    assert lattice.begin[-1] == len(lattice.start) and (np.diff(lattice.start) >= 0).all()
    for a, b in itertools.pairwise(lattice.begin.tolist()):
        assert b > a and (lattice.start[a:b] == lattice.start[a]).all()
        assert len(set(lattice.end[a:b].tolist())) == b - a
        assert math.isclose(np.exp(lattice.logp[a:b]).sum(), 1.0)


ODD_TEXTS = ["", "a", "あい \U0001f600é", "x" * 700, "of an it " * 300, " two  blanks \t\n", "reasonable words " * 90]


def test_sets_that_come_late_get_their_times_when_asked_for(pieces, monkeypatch):
    found = {}
    for near in (0.0, g.NEAR, np.inf):
        monkeypatch.setattr(g, "NEAR", near)
        found[near] = g.sampled(ODD_TEXTS * 20, keys(20 * len(ODD_TEXTS)), *pieces, 6)
    assert found[0.0] == found[np.inf] == found[48.0]
    assert len(found[0.0][0]) == 1 and max(map(len, found[0.0])) == 6


def test_few_random_numbers_are_made_for_an_edge(pieces, monkeypatch):
    mixed, made = g._mixed, []
    monkeypatch.setattr(g, "_mixed", lambda x: made.append(len(x)) or mixed(x))
    texts = ["some words of a longer text, and others " * 60] * 20
    out = g.sampled(texts, keys(len(texts)), *pieces, 2)
    edges = sum(len(ids) // 4 for own in out for ids, *_ in own)
    assert sum(made) < 2.5 * edges


def test_a_worker_reads_a_model_once(monkeypatch):
    of, made = g.Pieces.of, []
    monkeypatch.setattr(g.Pieces, "of", staticmethod(lambda *a: made.append(a) or of(*a)))
    assert g.loaded(MODEL, 1, 0.5) is g.loaded(MODEL, 1, 0.5) and len(made) == 1
    g.loaded(MODEL, 2, 0.5)
    assert len(made) == 2
    g.loaded.cache_clear()
