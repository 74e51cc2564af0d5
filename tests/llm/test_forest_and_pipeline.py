import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from eventpulse.llm import hash_forest as hf, language_id as lid, queries, secret_scan as sec
from eventpulse.llm.line_dedup import MIN_WORDS

from test_lines_urls_packing import brute_lines


def exact(rows, is_query, k):
    good = [
        (i, np.array(v, float)) for i, v in rows
        if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
    ]
    out = {}
    for q, x in good:
        if is_query(q):
            near = {}
            for i, y in good:
                if i != q and len(x) == len(y):
                    d = float(np.sqrt(((y - x) ** 2).sum()))
                    near[i] = min(d, near.get(i, np.inf))
            out[q] = sorted((d, i) for i, d in near.items())[:k]
    return out


def found(spark, rows, **more):
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr(
        "*", "1 AS dim", "2 AS codes", "3 AS part"
    )
    out = {}
    for r in hf.nearest_neighbours(table, F.col("vec_id") % 10 == 0, k=5, **more).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    return {q: [x[1:] for x in sorted(own)] for q, own in out.items()}


def test_all_candidates_give_the_exact_neighbours_whatever_the_blocks(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    rows += [(i, [1.0] * 6) for i in range(120, 200)]  # one vector many times, in blocks of 16
    rows += [(200, None), (201, []), (202, [0.0] * 6), (210, [float("nan")] * 6), (None, [1.0] * 6),
             (220, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (230, [1.0, 2.0]), (231, [2.0, 1.0]), (240, [float("inf")] * 6), (5, [1.0] * 6)]
    got = found(spark, rows, trees=3, share=1.0, block_rows=16)
    want = exact(rows, lambda i: i % 10 == 0, 5)
    assert {q: [i for _, i in n] for q, n in got.items()} == {q: [i for _, i in n] for q, n in want.items()}
    assert all(got[q] == [(pytest.approx(d), i) for d, i in want[q]] for q in want)


def test_few_rows_and_none(spark):
    assert found(spark, [(10, [1.0]), (11, [2.0])]) == {10: [(1.0, 11)]}
    assert found(spark, [(10, [1.0])]) == {} and found(spark, [(11, None)]) == {}


def test_recall_on_the_driver_vectors(spark):
    sf_dir = "/root/testdata/sf0.1"
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    ids, x = vectors.vec_id.to_numpy(), np.stack(vectors.embedding).astype(float)
    got = {}
    for r in queries.op10_nearest_neighbours(spark, sf_dir).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]].tolist())
        hits, total = hits + len(best & got[ids[q]]), total + len(best)
    assert hits >= 0.9 * total


COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark):
    rng = random.Random(8)
    words = {
        "en": "the and of that house there with when which people water".split(),
        "de": "der und das nicht haus dort mit wenn welche leute wasser".split(),
    }
    rows = []
    for i in range(60):
        lang = ("en", "de")[i % 2]
        text = "\n".join(" ".join(rng.choices(words[lang], k=40)) for _ in range(3))
        rows.append((i, text, lang, "s", len(text)))
    a, b = rows[0][1], rows[1][1]
    rows += [(60, a, "en", "s", 1), (61, b + "\nAKIA" + "B" * 16, "de", "s", 1), (62, None, "en", None, None),
             (63, "...", None, "s", 3), (64, "the house of people", None, None, 9), (65, "The House of people", "en", None, 9),
             (None, "the water of people there", "en", "s", 5), (7, rows[7][1], "de", "s", 1), (66, "", "en", "s", 0)]
    return spark.createDataFrame(rows, COLUMNS)


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = docs_of(spark)
    rows = {k: None for k in ("in", "out")}
    for name, stage in cp.STAGES[:-1]:
        rows["in"] = docs.collect()
        docs = spark.read.parquet(_written(stage(spark, docs, str(tmp_path)), tmp_path / name))
        rows["out"] = docs.collect()
        assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
        texts = {(r.doc_id, r.text) for r in rows["out"]}
        if name == "language_id":
            gone = {r.doc_id for r in rows["in"]} - {r.doc_id for r in rows["out"]}
            assert gone == {62, 63, 66}
        elif name == "line_dedup":
            order = sorted(rows["in"], key=lambda r: (r.doc_id is None, r.doc_id))
            left = brute_lines([r.text for r in order], MIN_WORDS)
            want = sorted(str((r.doc_id, t)) for r, t in zip(order, left) if t.strip())
            assert sorted(str((r.doc_id, r.text)) for r in rows["out"]) == want
            assert all(r.n_chars == len(r.text) for r in rows["out"])
        elif name == "simhash_near_dedup":
            assert (64, "the house of people") in texts and 65 not in {r.doc_id for r in rows["out"]}
            assert texts <= {(r.doc_id, r.text) for r in rows["in"]}
        else:
            want = {(r.doc_id, sec.redact(r.text)) for r in rows["in"]}
            assert texts == want and not any("AKIA" in t for _, t in texts)
    packed = cp.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sum(r.piece == 0 for r in packed) == len(rows["out"])


def _written(table, path):
    table.write.parquet(str(path))
    return str(path)


def test_pipeline_of_an_empty_table_and_of_driver_documents(spark, tmp_path):
    docs_of(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
    out = cp.run(spark, "/root/testdata/sf0.001").toPandas()
    assert (out.groupby("sequence_id").length.sum() <= 4096).all() and len(out) > 150
    assert lid.UNKNOWN == "und"


def test_an_id_repeated_more_than_k_times_hides_no_other(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(1, 60)] + [(100, [0.1] * 4)]
    rows += [(77, (0.1 + rng.normal(size=4) / 100).tolist()) for _ in range(40)]
    got, want = found(spark, rows, trees=2, share=1.0), exact(rows, lambda i: i % 10 == 0, 5)
    assert {q: [i for _, i in n] for q, n in got.items()} == {q: [i for _, i in n] for q, n in want.items()}
    assert want[100][0][1] == 77 and len(got[100]) == 5
